"""HTML extraction by wrapper induction over the pages of each host.

Pages of a host are told apart by layout, the set of their container tags and class names. Of each of its most frequent layouts the page with
the least hash is a sample. A page's DOM tree is folded: like siblings are one node with the children of all of them, so paths are label
paths. Each page is aligned with every sample of its host by simple tree matching (the largest number of matched nodes that keeps parents
and the order of siblings) and belongs to the sample that it matches best. Each task counts, for every block of text of a sample, on
how many of its pages the aligned node holds the same text; the counts are added up. A block that nearly all pages of a sample hold at the
same node is constant: it is template. Nodes whose text varies are slots, and their text is content. This works from two pages on; inside
an ``article`` or ``main`` element, which says that its text is content, a block needs more pages to be template. Fewer pages which have
most of their words in common are copies and tell nothing.

Not every varying slot is main text: menus, headers, footers, sidebars, notices, adverts, forms and comments vary from page to page,
too. These are told by the standard's elements and by whole class, id and role names (``share-bar``, not ``related-work``); a page's
``article`` (else ``main``) elements, where it has some, hold the content. Blocks are never dropped for their length or position.

Samples keep names and hashes, not text, so what meets the pages of a host is a few kilobytes; Spark picks the
join by its size. Alignments depend on structure alone and are kept by structure.

Defined cases: null or empty html gives empty text; a null url, or one without ``://``, has an empty host, whose pages are held together; one page of a
host has nothing to be compared with and keeps all blocks; page_ids that repeat give a row each; a page without markup is one block; elements
may be nested to any depth, and those deeper than ``SHAPE_DEPTH`` are aligned as parts of the one at that depth; empty
input gives empty output; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatloom.llm import dom
from seatloom.llm.url_filter import host_of
from seatloom.runtime import in_arrow, materialise

#: A block is template if at least this share of a sample's pages, and so many of them, hold it at its node.
CONSTANT_SHARE, CONSTANT_PAGES = 0.95, 2
#: Pages that a block inside an article needs to be template; fewer pages with most words in common are copies.
ARTICLE_PAGES = 8
#: Most samples of one host.
SAMPLES = 4
SHAPE_DEPTH = 40

# Elements without main text, and names given to such regions.
DROPPED = frozenset(
    "script style noscript template head title iframe object embed svg math canvas audio video nav aside footer form button select option textarea input label dialog menu map".split()
)
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert
    popup modal overlay newsletter subscribe subscription signup login sidebar side aside widget related recommended recommendations menu nav navbar navigation
    breadcrumb breadcrumbs pagination pager toolbar footer masthead header comment comments commentlist discussion replies reply disqus
    respond share sharing social search skip toc""".split()
)
#: Words that a region's name may hold besides: a name with any other word says nothing.
PLAIN = frozenset(
    """bar box block list area section wrapper wrap container inner outer panel pane zone slot unit link links button buttons form top bottom left right
    item items post posts article articles story stories entry entries content body page site global main primary secondary sub mobile desktop js u c o l m""".split()
)
SPLIT = str.maketrans("-_:", "   ")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Parts of a name that a main region can carry beside those above ("article-header" keeps its title).
MAIN = frozenset("article content main post entry story body".split())


@lru_cache(maxsize=1 << 14)
def names_region(name: str, inside: bool) -> bool:
    """Whether a whole name is that of a region without main text; ``inside``: within the article."""
    parts = re.sub("[0-9]+", " ", name.translate(SPLIT)).split()
    found = [p for p in parts if p in NAMES]
    if not found or any(p not in NAMES and p not in PLAIN for p in parts):
        return False
    # the header of an article holds its title
    return not (set(found) == {"header"} and (inside or any(p in MAIN for p in parts)))


def is_dropped(node: dom.Node, inside: bool, wrappers: frozenset[int] = frozenset()) -> bool:
    """Whether a node is outside the main text; ``inside``: within the article; ``wrappers``: nodes whose class names and ids don't count."""
    if node.tag in DROPPED or node.tag == "header" and not inside:
        return True
    if not node.attributes:
        return False
    if node.attribute("hidden") is not None or (node.attribute("aria-hidden") or "").lower() == "true":
        return True
    if (node.attribute("role") or "").lower() in ROLES:
        return True
    return id(node) not in wrappers and any(names_region(name, inside) for name in node.names())


#: Names of regions that may hold most of a page's text and are still no main text.
READERS = frozenset("comment comments commentlist discussion replies reply disqus respond".split())


def wrappers_of(page: dom.Node) -> frozenset[int]:
    """Nodes with at least half of the page's text, other than readers' comments: their names can't tell that they are side regions."""
    order, stack = [], [page]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if not isinstance(c, str) and c.tag not in DROPPED]
    sizes: dict[int, int] = {}
    for node in reversed(order):
        sizes[id(node)] = sum(len("".join(c.split())) if isinstance(c, str) else sizes.get(id(c), 0) for c in node.children)
    half = sizes[id(page)] / 2
    return frozenset(id(n) for n in order if sizes[id(n)] >= half and not any(p in READERS for name in n.names() for p in name.translate(SPLIT).split()))


def roots(page: dom.Node, wrappers: frozenset[int] = frozenset()) -> list[dom.Node]:
    """The outermost article elements that hold the content, else all outermost main elements, else the whole page.

    Where there are none outside regions of such names, a wrapper of half of the page's text is searched in spite of its name.
    """
    return regions(page, wrappers) or regions(page, wrappers or wrappers_of(page)) or [page]


def regions(page: dom.Node, wrappers: frozenset[int]) -> list[dom.Node]:
    """Outermost articles, else outermost mains; none where there are neither."""
    articles: list[dom.Node] = []
    mains: list[dom.Node] = []
    stack = [(page, False)]
    while stack:
        node, inside = stack.pop()
        if node is not page:
            if is_dropped(node, False, wrappers):
                continue
            if node.tag == "article":
                articles.append(node)
                continue
            main = node.tag == "main" or bool(node.attributes) and (node.attribute("role") or "").lower() == "main"
            if main and not inside:
                mains.append(node)
            inside = inside or main
        stack += [(c, inside) for c in reversed(node.children) if not isinstance(c, str)]
    return articles or mains


class Block:
    """Text of one block, the path of the folded node that holds it, and whether that is inside an article."""

    __slots__ = ("path", "text", "hash", "inside")

    def __init__(self, path: tuple[int, ...], text: str, inside: bool):
        self.path, self.text, self.hash, self.inside = path, text, zlib.crc32(text.encode("utf-8", "surrogatepass")), inside


def label(node: dom.Node) -> str:
    """Tag and classes; numbers in names don't count."""
    return node.tag + re.sub("[0-9]+", "", "".join(f".{c}" for c in (node.attribute("class") or "").lower().split())) if node.attributes else node.tag


class Folded:
    """A node of the folded tree."""

    __slots__ = ("name", "path", "kids")

    def __init__(self, name: str, path: tuple[int, ...]):
        self.name, self.path = name, path
        self.kids: dict[str, Folded] = {}

    def kid(self, name: str) -> Folded:
        if len(self.path) >= SHAPE_DEPTH:
            return self
        if name not in self.kids:
            self.kids[name] = Folded(name, (*self.path, len(self.kids)))
        return self.kids[name]

    def shape(self) -> tuple:
        return (self.name, tuple(k.shape() for k in self.kids.values()))


def read(html: str | None) -> tuple[tuple, list[Block]]:
    """Folded structure of a page, as nested (label, children), and the blocks of its main text.

    Where names would leave nothing of a page (a body or an outer wrapper named like a side region), they don't count.
    """
    tree = dom.parse(html or "")
    shape, blocks = blocks_of(tree, frozenset())
    return (shape, blocks) if blocks else blocks_of(tree, wrappers_of(tree))


def blocks_of(tree: dom.Node, wrappers: frozenset[int]) -> tuple[tuple, list[Block]]:
    chosen = roots(tree, wrappers)
    held, whole = {id(r) for r in chosen}, chosen[0] is tree
    blocks: list[Block] = []
    pending: list[str] = []

    def flush(path: tuple[int, ...]) -> None:
        if pending:
            if text := dom.squeezed("".join(pending)):
                blocks.append(Block(path, text, not whole))
            pending.clear()

    top = Folded("#root", ())
    # open nodes: folded node, children to come, whether text counts, whether within the article, whether a block ends here
    stack = [(top, iter(tree.children), whole, False, False)]
    while stack:
        folded, children, main, article, ends = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if ends:
                flush(folded.path)
        elif isinstance(child, str):
            if main:
                pending.append(child)
        else:
            inside = main or id(child) in held
            dropped = main and id(child) not in held and is_dropped(child, article, wrappers)
            named = article or id(child) in held or any(p in MAIN for name in child.names() for p in name.translate(SPLIT).split())
            if main and child.tag == "br":
                pending.append(" ")
            block = child.tag not in dom.INLINE
            if block:
                flush(folded.path)
            stack.append((folded.kid(label(child)), iter(child.children), inside and not dropped, named, block))
    flush(())
    return top.shape(), blocks


@lru_cache(maxsize=4096)
def aligned(template: tuple, page: tuple) -> dict[tuple[int, ...], tuple[int, ...]]:
    """Simple tree matching: page paths -> template paths of a largest matching."""
    sizes: dict[tuple[int, int], int] = {}

    def table(a: tuple, b: tuple) -> list[list[int]]:
        m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
        for i, x in enumerate(a[1], 1):
            for j, y in enumerate(b[1], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size(x, y))
        return m

    def size(a: tuple, b: tuple) -> int:
        if a[0] != b[0]:
            return 0
        key = (id(a), id(b))
        if key not in sizes:
            sizes[key] = 1 + table(a, b)[-1][-1]
        return sizes[key]

    found: dict[tuple[int, ...], tuple[int, ...]] = {(): ()}
    stack = [(template, page, (), ())]
    while stack:
        a, b, at, bt = stack.pop()
        m = table(a, b)
        i, j = len(a[1]), len(b[1])
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found[(*bt, j)] = (*at, i)
                stack.append((a[1][i], b[1][j], (*at, i), (*bt, j)))
    return found


def tuples(x: list) -> tuple:
    return (x[0], tuple(tuples(c) for c in x[1]))


def size_of(shape: tuple) -> int:
    return 1 + sum(map(size_of, shape[1]))


@lru_cache(maxsize=4096)
def decoded(sample: str) -> tuple[tuple, dict[tuple[tuple[int, ...], int], int]]:
    """A sample's structure and its blocks: (path, text hash) -> block number."""
    shape, blocks = json.loads(sample)
    return tuples(shape), {(tuple(path), h): i for i, (path, h) in enumerate(blocks)}


@lru_cache(maxsize=8192)
def likeness(template: tuple, page: tuple) -> float:
    """Share of the nodes of both trees that are matched."""
    return 2 * len(aligned(template, page)) / (size_of(template) + size_of(page))


#: Container tags and class names, which tell layouts apart.
CONTAINER = r"<(div|section|main|article|aside|header|footer|nav|ul|table|form)\b"
CLASSES = r"""\bclass\s*=\s*["']?([^"'>]*)"""


def samples(pages: DataFrame, most: int) -> DataFrame:
    """host, samples: folded structures and block hashes of the pages of least hash of the host's most frequent layouts, as JSON."""
    low = F.lower("html")
    layout = F.xxhash64(
        F.array_sort(F.array_distinct(F.regexp_extract_all(low, F.lit(CONTAINER), 1))),
        F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(low, F.lit(CLASSES), 1), lambda c: F.regexp_replace(c, "[0-9]+", "")))),
    )
    # hashes first, then only the chosen pages' html
    keyed = pages.select("host", "html", F.xxhash64("page_id", "html").alias("key"))
    layouts = pages.select("host", layout.alias("layout"), F.xxhash64("page_id", "html").alias("key")).groupBy("host", "layout").agg(F.count("*").alias("n"), F.min("key").alias("l_key"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "layout"))
    least = materialise(layouts.withColumn("place", place).filter(F.col("place") <= most).select(F.col("host").alias("l_host"), "l_key", "place"), "sample-keys")
    chosen = keyed.join(least, (F.col("host") == F.col("l_host")) & (F.col("key") == F.col("l_key"))).dropDuplicates(["host", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html in batch.column(2).to_pylist():
                shape, blocks = read(html)
                seen = {(b.path, b.hash): b.inside for b in blocks}
                out.append((json.dumps([shape, list(seen)], separators=(",", ":")), list(seen.values())))
            made = [pa.array([s for s, _ in out], pa.string()), pa.array([i for _, i in out], pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["host", "place", "sample", "inside"])

    rows = in_arrow(chosen.select("host", "place", "html"), run, "host string, place int, sample string, inside array<boolean>")
    return materialise(rows, "samples")


def hits(found: list[str], html: str | None) -> tuple[list[Block], int, list[int | None]]:
    """A page's blocks, the sample it matches best, and for each block the number of the sample's block that its aligned node holds with the same text."""
    shape, blocks = read(html)
    likest = max(range(len(found)), key=lambda i: (likeness(decoded(found[i])[0], shape), -i))
    template, numbers = decoded(found[likest])
    to = aligned(template, shape)
    return blocks, likest, [numbers.get((to[b.path], b.hash)) if b.path in to else None for b in blocks]


def content(blocks: list[Block], found: list[int | None], constant: set[int], copies: bool) -> list[str]:
    """What stays of a page's blocks; ``copies``: its sample has few pages."""
    kept = [b.text for b, f in zip(blocks, found, strict=True) if f is None or f not in constant]
    every = [b.text for b in blocks]
    words = lambda texts: sum(len(t.split()) for t in texts)
    # pages that are all alike have no slots: nothing tells their template from their content
    return every if not kept or copies and 2 * words(kept) < words(every) else kept


def extract(
    pages: DataFrame, share: float = CONSTANT_SHARE, least: int = CONSTANT_PAGES, article_pages: int = ARTICLE_PAGES, samples_of_host: int = SAMPLES
) -> DataFrame:
    """Pages (page_id, url, html) -> page_id, url, text, n_chars."""
    hosted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    sampled = samples(hosted, samples_of_host)
    by_place = F.array_sort(F.collect_list(F.struct("place", "sample")))
    of_host = sampled.groupBy(F.col("host").alias("s_host")).agg(by_place["sample"].alias("samples"))
    met = hosted.join(of_host, F.col("host") == F.col("s_host"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys = list(seen)
            columns = [pa.array([h for h, _, _ in keys], pa.string()), pa.array([p for _, p, _ in keys], pa.int32()), pa.array([b for _, _, b in keys], pa.int32())]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], ["host", "place", "block", "n"])
            seen.clear()
            return out

        for batch in batches:
            for host, found, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, likest, numbers = hits(found, html)
                seen[host, likest + 1, -1] += 1  # the number of pages
                seen.update((host, likest + 1, b) for b in set(numbers) - {None})
            if len(seen) > 100_000:
                yield rows()
        yield rows()

    counted = in_arrow(met.select("host", "samples", "html"), count, "host string, place int, block int, n long").groupBy("host", "place", "block").agg(F.sum("n").alias("n"))
    by_sample = counted.groupBy(F.col("host").alias("c_host"), F.col("place").alias("c_place")).agg(
        F.max(F.when(F.col("block") < 0, F.col("n"))).alias("pages"), F.collect_list(F.when(F.col("block") >= 0, F.struct("block", "n"))).alias("blocks")
    )
    enough = lambda b: F.when(F.get("inside", b["block"]), article_pages).otherwise(least)
    constant = F.filter("blocks", lambda b: (b["n"] >= enough(b)) & (b["n"] >= F.col("pages") * share))["block"]
    judged = sampled.join(by_sample, (F.col("host") == F.col("c_host")) & (F.col("place") == F.col("c_place")), "left")
    judged = judged.select("host", "place", "sample", F.struct(constant.alias("constant"), (F.col("pages") < article_pages).alias("few")).alias("judged"))
    wrappers = judged.groupBy(F.col("host").alias("s_host")).agg(F.array_sort(F.collect_list(F.struct("place", "sample", "judged"))).alias("wrappers"))
    wrappers = materialise(wrappers.select("s_host", F.col("wrappers.sample").alias("samples"), F.col("wrappers.judged").alias("judged")), "wrappers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, found, judged in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                blocks, likest, numbers = hits(found, html)
                own = judged[likest]
                texts.append("\n".join(content(blocks, numbers, set(own["constant"] or ()), bool(own["few"]))))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    rows = hosted.join(wrappers, F.col("host") == F.col("s_host")).select("page_id", "url", "html", "samples", "judged")
    return in_arrow(rows, cut, "page_id long, url string, text string, n_chars long")
