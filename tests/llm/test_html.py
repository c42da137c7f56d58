"""HTML extraction on pages whose main text is known."""

import random
import re
from html import unescape

import pytest

from seatloom.llm import dom, html_extract

SCHEMA = "page_id long, url string, html string"


def texts(pages):
    return {r.page_id: r.text for r in html_extract.extract(pages).collect()}


def test_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = html_extract.extract(pages).collect()
    assert len(got) == pages.count()
    source = {r.page_id: r.html for r in pages.collect()}
    for r in got:
        article = re.search("<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def page(n, rng, body=None):
    """A page with all sorts of regions round its text, and the text."""
    say = lambda k: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    title, paragraphs = say(4), [say(12) for _ in range(rng.randint(2, 6))]
    main = f"<h1>{title}</h1>" + "".join(f"<p>{p} &amp; <a href='/x'>more</a>\n  here</p>" for p in paragraphs)
    want = "\n".join([title] + [f"{p} & more here" for p in paragraphs])
    body = body or "<article class='post-content'>{main}<aside>{x}</aside><form>{x}</form><p class='notice'>{x}</p></article>"
    html = (
        f"<html><head><title>{title}</title><style>a{{}}</style></head><body><header><a href='/'>Site {say(2)}</a></header><nav><ul><li>{say(1)}<li>{say(1)}</ul></nav>"
        f"<div class='cookie-notice'>{say(6)}</div><div id='sidebar'><p>{say(5)}</p></div>{body.format(main=main, x=say(4))}"
        f"<section id='comments'><article class='comment'><p>{say(9)}</p></article></section><div class=ad>{say(3)}</div><footer>&copy; {say(2)}</footer><script>var t='<p>no</p>';</script></body></html>"
    )
    return (n, f"https://host{n % 3}.org/{n}", html), want


def test_regions_round_the_text(spark):
    rng = random.Random(2)
    bodies = [None, "<main>{main}<div class='share-bar'>{x}</div></main>", "<div class='article-content'>{main}</div>"]
    made = [page(n, rng, bodies[n % 3]) for n in range(60)]
    got = texts(spark.createDataFrame([r for r, _ in made], SCHEMA))
    assert [got[r[0]] for r, _ in made] == [w for _, w in made]


def test_every_main_region_is_kept(spark):
    html = "<body><p>out</p><main><p>one</p><div role='main'><p>two</p></div></main><div role=main><p>three</p></div><p>off</p></body>"
    assert texts(spark.createDataFrame([(1, "http://mains.net/", html)], SCHEMA)) == {1: "one\ntwo\nthree"}


def test_constant_nodes_are_template(spark):
    """An unnamed block that every page of the host holds at the same node goes; on too few pages it stays."""
    rows = [(n, f"http://big.net/{n}", f"<body><div><p>Welcome to the same place</p></div><div><h2>t{n}</h2><p>words {n} of it</p></div></body>") for n in range(20)]
    rows += [(100 + n, f"http://small.net/{n}", f"<body><p>Welcome to the same place</p><p>n {n}</p></body>") for n in range(3)]
    rows += [(200 + n, "http://alike.net/", "<p>One text</p><p>for all</p>") for n in range(12)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[n] == f"t{n}\nwords {n} of it" for n in range(20))
    assert all(got[100 + n] == f"Welcome to the same place\nn {n}" for n in range(3))
    assert all(got[200 + n] == "One text\nfor all" for n in range(12))


def test_two_pages_are_enough(spark):
    """No tag or name tells what is content: what both pages of a host hold at one node is template."""
    say = lambda n, k: " ".join(f"w{n}x{i}" for i in range(k))
    page = lambda n: f"<div><p>Best shop</p><p>Call us</p></div><div><h2>t{n}</h2><p>{say(n, 30)}</p></div><div><p>All prices in coins</p></div>"
    rows = [(n, f"http://two.net/{n}", page(n)) for n in range(2)] + [(9, "http://one.net/", page(9))]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[n] == f"t{n}\n{say(n, 30)}" for n in range(2))
    assert got[9] == f"Best shop\nCall us\nt9\n{say(9, 30)}\nAll prices in coins"


def test_layouts_of_one_host(spark):
    """Each layout has its own template; an error page spoils none."""
    say = lambda n, k: " ".join(f"w{n}x{i}" for i in range(k))
    one = lambda n: f"<div class=a><p>Front text of one</p></div><div class=b><p>{say(n, 20)}</p></div>"
    two = lambda n: f"<table><tr><td>Cell text of two<td><p>{say(n, 20)}</p></table><div class=z><p>End of two</p></div>"
    rows = [(n, f"http://mix.net/{n}", one(n) if n % 5 < 3 else two(n)) for n in range(40)] + [(99, "http://mix.net/oops", "<h1>Not found</h1>")]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[n] == say(n, 20) for n in range(40)) and got[99] == "Not found"


def test_names_are_matched_whole(spark):
    inner = "<h1>Head</h1><p class='side-effects'>a</p><section class=related-work><p>b</p></section><div class=search-algorithms>c</div><div id=notice-of-meeting>d</div><p class='main-menu'>x</p><div class='comments-area2'>x</div><div class='share-bar'>x</div>"
    rows = [(1, "http://n.net/1", f"<nav>x</nav><article>{inner}</article>"), (2, "http://m.net/2", f"<div>{inner}</div>"), (3, "http://o.net/", "<div class=article-header><h1>Title</h1></div><div class='site-header'>x</div><p>y</p>")]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert got == {1: "Head\na\nb\nc\nd", 2: "Head\na\nb\nc\nd", 3: "Title\ny"}


def test_deep_elements(spark):
    deep = lambda n, x: "<div>" * n + x + "</div>" * n
    rows = [(1, "http://deep.net/", deep(20, "<nav>menu link</nav><p>text</p>")), (2, "http://deeper.net/", deep(2100, "<nav>menu link</nav><p>text</p>")), (3, "http://deepest.net/", "<b>" * 20_000 + "bold" + "<p>par</p></i>" * 2000)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert got[1] == got[2] == "text" and got[3].startswith("bold\npar") and got[3].count("par") == 2000


def brute_matching(a, b):
    """Largest number of matched nodes, by trying every choice."""
    if a[0] != b[0]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_matching(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a[1], b[1])


def test_simple_tree_matching_is_largest():
    rng = random.Random(6)

    def tree(depth):
        return (rng.choice("ab"), tuple(tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)))

    for _ in range(200):
        a, b = ("r", tree(3)[1]), ("r", tree(3)[1])
        found = html_extract.aligned(a, b)
        assert len(found) == brute_matching(a, b) and len(set(found.values())) == len(found)
        for page, template in found.items():
            assert not page or found[page[:-1]] == template[:-1]


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "x", ""), (3, "http://a/", "just text &lt;b&gt;\n\n two"), (4, "http://a/", "<p>one<p>two<br>three<b>four</p>five"),
        (5, "http://a/", "<div>" * 3000 + "deep" + "</div>" * 3000), (6, "http://a/", "<p title='it\">x</p><p>open <i"), (7, "http://a/", "<script>never closed <p>x"),
        (8, "http://a/", "<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>"), (None, "http://a/", "<!-- <p>no</p> --><![CDATA[yes]]><!doctype html>"),
        (9, "http://a/", "<p>" + "word " * 200_000 + "</p>"), (9, "http://a/", "<pre> kept \t here </pre><textarea>no</textarea>&nbsp;&#x41;&bogus;"),
    ]
    got = [(r.page_id, r.text) for r in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(rows)
    by = {i: t for i, t in got if i != 9}
    assert by[1] == by[2] == by[7] == "" and by[3] == "just text <b> two" and by[4] == "one\ntwo threefour\nfive" and by[5] == "deep"
    assert by[8] == "a\nb\nc\nd\ne\nf" and by[None] == "yes"
    assert sorted(t for i, t in got if i == 9) == ["kept here\nA&bogus;", "word " * 199_999 + "word"]
    assert html_extract.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_simple_tree_matching():
    a = ("r", (("x", (("p", ()), ("q", ()))), ("y", ()), ("z", ())))
    b = ("r", (("y", ()), ("x", (("q", ()),)), ("z", ())))
    assert html_extract.aligned(a, b) == {(): (), (1,): (0,), (1, 0): (0, 1), (2,): (2,)}


def test_parse_keeps_all_text():
    tree = dom.parse("a<p>b<div>c</p>d</div>e")

    def walk(n):
        return "".join(c if isinstance(c, str) else walk(c) for c in n.children)

    assert walk(tree) == "abcde"


@pytest.mark.parametrize("wrapper", ['<body class="sidebar-right">{}</body>', '<body class="search">{}</body>', '<p>Top.</p><div class="content-sidebar-wrap">{}</div>', '<div class="menu-top">{}</div>', '<body id="popup"><div class="banner">{}</div></body>'])
@pytest.mark.parametrize("inner", ["<article><p>First words of it.</p><div class='share'>Share</div></article>", "<main><p>First words of it.</p></main>"])
def test_names_of_wrappers_blank_no_page(spark, wrapper, inner):
    page = "<html>" + wrapper.format("<nav>Home</nav>" + inner + '<div class="comments"><article>Nice.</article></div>') + "</html>"
    rows = spark.createDataFrame([(i, f"http://a.example/{i}", page.replace("First", f"First{i}")) for i in range(3)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(rows).collect()}
    assert all(f"First{i} words of it." in got[i] for i in range(3))


def test_comments_are_no_article(spark):
    page = '<body><div class="x"><p>Long text of the page itself, more than the comments hold.</p></div><div class="comments"><article>Nice.</article></div></body>'
    assert [b.text for b in html_extract.read(page)[1]] == ["Long text of the page itself, more than the comments hold."]
