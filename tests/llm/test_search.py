"""Top-k search, decontamination, URL filters against brute force; language ID by held-out accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seatloom.llm import bm25, decontaminate, language_id, many_search, topk_search, url_filter

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_topk(rows, is_query, k=10, m=1 << 40):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n = len(docs)
    mean = sum(x for *_, x in docs) / max(n, 1)
    df = Counter(t for _, c, _ in docs for t in c)
    idf = {t: math.floor(math.log(1 + (n - f + 0.5) / (f + 0.5)) * 1_000_000) for t, f in df.items()}
    out = set()
    for q, c, _ in docs:
        if not is_query(q):
            continue
        asked = sorted(c, key=lambda t: (-c[t] * idf[t], t.encode()))[:m]
        scored = []
        for d, o, length in docs:
            s = sum(math.floor(idf[t] * (o[t] * 2.2 / (o[t] + 1.2 * (1 - 0.75 + 0.75 * length / mean)))) for t in asked if t in o)
            if s or any(t in o for t in asked):
                scored.append((-s, d is not None, d or 0, d))
        out |= {(q, i, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("cut", [{}, {"shard_terms": 2000, "set_terms": 8000, "bucket": 2}, {"terms": 16, "block_terms": 300}])
def test_topk(real, none, cut):
    rows = [(r.doc_id, r.text) for r in real.collect()]
    got = {tuple(r) for r in topk_search.search(real, F.col("doc_id") % 50 == 0, **cut).collect()}
    assert got == brute_topk(rows, lambda d: d % 50 == 0, m=cut.get("terms", 1 << 40))
    assert topk_search.search(none, F.lit(True)).count() == 0


def test_topk_odd(spark, odd):
    rows = [(1, "a b c"), (1, "a b d"), (None, "a z"), (4, "q"), (6, "q a b c " * 9)] + [(10 + i, "a") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = topk_search.search(docs, F.col("doc_id").isin(4, 6), bucket=1).collect()
    assert {tuple(r) for r in got} == brute_topk(rows, lambda d: d in (4, 6))
    found = {r.query_id for r in topk_search.search(odd, F.lit(True)).collect()}
    assert found == {1, 2, 5, 6, 7, 8, 9, 10}  # a no-break space is a term


def test_topk_repeated_query_asks_each_term_once(spark):
    text = " ".join(f"t{i:02}" for i in range(40))
    rows = [(1, text), (1, text)] + [(100 + i, f"t{i:02} filler") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for m, n in ((16, 18), (1 << 40, 42)):
        got = {tuple(r) for r in topk_search.search(docs, F.col("doc_id") == 1, k=50, terms=m).collect()}
        assert got == brute_topk(rows, lambda d: d == 1, k=50, m=m)
        assert len(got) == n


def random_lists(rng, n):
    """Lists with their weights, frequencies and the exact scores."""
    sizes, docs, sats, weights, total = [], [], [], [], np.zeros(n)
    for _ in range(int(rng.integers(1, 60))):
        own = np.flatnonzero(rng.random(n) < rng.random() ** 4)
        if len(own):
            sat, weight = rng.integers(1, 9, len(own)) / 8, float(rng.integers(1, 200))
            total[own] += np.floor(weight * sat)
            sizes, docs, sats, weights = [*sizes, len(own)], [*docs, own], [*sats, sat], [*weights, weight]
    if not sizes:
        return random_lists(rng, n)
    return bm25.Lists(np.array(sizes), np.concatenate(docs), np.concatenate(sats), n), np.array(weights), total


def test_block_max_pruning_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(80):
        n = int(rng.integers(1, 3000))
        lists, weights, total = random_lists(rng, n)
        every = np.arange(len(weights))
        searcher = bm25.Searcher(lists, np.argsort(lists.docs, kind="stable"))
        held = np.zeros(n, bool)
        held[lists.docs] = True
        for k in (1, 10):
            order = [d for d in np.lexsort((np.arange(n), -total)) if held[d]][:k]
            for floor in (0.0, total[order[-1]]):
                docs, scores = searcher.top_k(every, weights, k, floor)
                assert docs.tolist() == order and scores.tolist() == total[order].tolist()
        limits = rng.integers(1, 2 + int(total.max()), n)
        least = np.minimum.reduceat(limits, np.arange(0, n, bm25.BLOCK))
        assert bm25.above(lists, every, weights, limits, least)[0].tolist() == np.flatnonzero(total >= limits).tolist()


def test_pruning_saves_postings(real):
    """With a floor from earlier shards a good part of the postings that whole queries ask for is never scored, though all results are exact."""
    rows = [r.text for r in real.collect()]
    builder, texts = topk_search.ShardBuilder(), [bm25.terms_of((t or "").encode()) for t in rows * 10]
    for i, w in enumerate(texts):
        builder.add(i, w + [b"own%d" % i] * 3)
    shard = builder.batch(0)
    blobs = [np.frombuffer(shard.column(n)[0].as_py(), kind) for n, kind in (("docs", np.int32), ("tfs", np.int32), ("ids", np.int64), ("lengths", np.int32), ("forward", np.int32))]
    terms, sizes = shard.column("terms")[0].as_py(), shard.column("sizes")[0].values.to_numpy()
    weight = dict(zip(terms, bm25.idf(len(texts), sizes).tolist(), strict=True))
    asked = [(i, t, weight[t]) for i in range(0, 200, 20) for t in dict.fromkeys(texts[i])]
    table = pa.table(dict(zip(("query_id", "term", "weight"), (pa.array(c) for c in zip(*asked, strict=True)), strict=True)))
    search = topk_search.BlockSearch(topk_search.Block(table), float(np.mean(blobs[3])), 10)
    search.add(terms, sizes, *blobs)
    search.scored = search.asked = 0
    search.add(terms, sizes, *blobs)
    assert search.scored < 0.5 * search.asked


def random_index(rng, n, words):
    """Two shards of documents with copies, ties and a null id, and what each of many queries asks for."""
    texts = [[b"w%d" % i for i in (rng.zipf(1.3, int(rng.integers(1, 60))) % words)] for _ in range(n)]
    texts += texts[: n // 4]
    shards = []
    for half in (range(0, len(texts), 2), range(1, len(texts), 2)):
        builder = topk_search.ShardBuilder()
        for i in half:
            builder.add(None if i == 3 else 1000 - i, texts[i])
        shard = builder.batch(0)
        kinds = (("docs", np.int32), ("tfs", np.int32), ("ids", np.int64), ("lengths", np.int32), ("forward", np.int32))
        shards.append((shard.column("terms")[0].as_py(), shard.column("sizes")[0].values.to_numpy(), *(np.frombuffer(shard.column(c)[0].as_py(), kind) for c, kind in kinds)))
    df = Counter(t for w in texts for t in set(w))
    weight = dict(zip(df, bm25.idf(len(texts), list(df.values())).tolist(), strict=True)) | {b"w1": 0}
    asked = [(i, t, weight[t]) for i in range(0, n, 2) for t in dict.fromkeys(texts[i])] + [(n + 1, b"w1", 0), (n + 2, b"w2", weight[b"w2"])]
    return shards, pa.table(dict(zip(("query_id", "term", "weight"), (pa.array(c) for c in zip(*asked, strict=True)), strict=True)))


def test_many_queries_are_searched_together(monkeypatch):
    """Products over groups of queries and documents give what each query gives by itself, without a pass over the postings for each query."""
    rng, calls, top_k = np.random.default_rng(5), [], bm25.Searcher.top_k
    monkeypatch.setattr(bm25.Searcher, "top_k", lambda self, *a: calls.append(1) or top_k(self, *a))
    for n, words, limits in ((300, 50, {}), (300, 4000, {"CHUNK": 64, "GROUP": 16, "POSTS": 50, "PAIRS": 3}), (500, 400, {"CHUNK": 128, "HOT": 20}), (500, 400, {"HOT": 0})):
        for name, value in limits.items():
            monkeypatch.setattr(many_search, name, value)
        shards, table = random_index(rng, n, words)
        block, found = topk_search.Block(table), []
        for cut in ({}, {"many": 1 << 40}):
            search = topk_search.BlockSearch(block, 30.0, 10, **cut)
            calls.clear()
            for shard in shards:
                search.add(*shard)
            found.append((search.batch().to_pydict(), len(calls)))
        assert found[0][0] == found[1][0]
        assert found[0][1] < 0.2 * found[1][1]


def test_memory_of_a_shard_is_small():
    """A block is held as bytes, not as Python's words, and a shard is searched without copies of all its postings in doubles."""
    import tracemalloc

    rng, builder = np.random.default_rng(7), topk_search.ShardBuilder()
    words = [b"w%d" % i for i in range(60_000)]
    for i in range(4000):
        builder.add(i, [words[j] for j in rng.integers(0, len(words), 200)])
    shard = builder.batch(0)
    kinds = (("docs", np.int32), ("tfs", np.int32), ("ids", np.int64), ("lengths", np.int32), ("forward", np.int32))
    blobs = [np.frombuffer(shard.column(c)[0].as_py(), kind) for c, kind in kinds]
    terms, sizes = shard.column("terms")[0].values, shard.column("sizes")[0].values.to_numpy()
    asked = [(q, w, 1000 + q) for q in range(128) for w in words[q::1000]]
    table = pa.table(dict(zip(("query_id", "term", "weight"), (pa.array(c) for c in zip(*asked, strict=True)), strict=True)))
    tracemalloc.start()
    block = topk_search.Block(table)
    held = tracemalloc.get_traced_memory()[0]
    search = topk_search.BlockSearch(block, 200.0, 10)
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    search.add(terms, sizes, *blobs)
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    postings = len(blobs[0])
    assert held < 25 * len(asked) and most < 35 * postings


def test_blocks_of_queries_come_one_by_one(spark, real, monkeypatch):
    """A block is made when the result of the one before is written."""
    told, block, write = [], topk_search.Block.__init__, topk_search.materialise
    monkeypatch.setattr(topk_search.Block, "__init__", lambda self, rows: told.append("block") or block(self, rows))
    monkeypatch.setattr(topk_search, "materialise", lambda df, name: told.append("found") or write(df, name) if name.startswith("found") else write(df, name))
    topk_search.search(real.limit(40), F.lit(True), bucket=10)
    assert len(told) > 4 and told == ["block", "found"] * (len(told) // 2)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_topk_many_queries(spark, real):
    rows = [(r.doc_id, r.text) for r in real.collect()][:120]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in topk_search.search(docs, F.lit(True), shard_terms=20_000).collect()}
    assert got == brute_topk(rows, lambda d: True)


def brute_leaks(docs, items):
    """By the definition: five-word shingles of an item, its question or its answer of which 0.8 stand in the document."""
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    out = Counter()
    for d, t in docs:
        w = terms(t)
        for i, x in items:
            shares = {}
            for name, part in zip(("item", "question", "answer"), (x, *decontaminate.split_item(x)), strict=True):
                own = grams(terms(part))
                n = len(next(iter(own))) if own else 0
                have = {tuple(w[a : a + n]) for a in range(len(w) - n + 1)} if n else set()
                if own and len(own & have) / len(own) >= 0.8 and (name == "item" or len(terms(part)) >= 10):
                    shares[name] = len(own & have) / len(own)
            if shares:
                out[d, i, ",".join(shares), round(shares.get("item", 0), 6)] += 1
    return out


def found_leaks(rows):
    return Counter((r.doc_id, r.item_id, r.found, round(r.overlap, 6) if "item" in r.found else 0) for r in rows)


def test_decontaminate(spark, sf_dir, odd, none, real):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = [(r.item_id, r.text) for r in items.collect()]
    long = held[2][1].split()
    rows = [(1, " ".join(long[:-3])), (2, "x " * 50 + " ".join(long[2:]).upper() + " y"), (3, " ".join(long[: len(long) // 2])), (4, " ".join(reversed(long)))]
    near = spark.createDataFrame(rows, "doc_id long, text string")
    more = items.select("item_id", "text").unionByName(spark.createDataFrame([(900, "Three little words."), (901, None), (902, ""), (None, "x")], "item_id long, text string"))
    every = [(r.item_id, r.text) for r in more.collect() if r.item_id is not None and r.text is not None]
    scores = []
    for docs in (real, odd, near):
        want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], every)
        for per in (20_000, 15):
            got = decontaminate.leaks(docs, more, items_per_part=per).collect()
            assert found_leaks(got) == want
            scores.append(sorted((r.doc_id or 0, r.item_id, r.score) for r in got))
    # statistics are those of all items, so scores don't depend on how items are dealt
    assert scores[0::2] == scores[1::2]
    kept = decontaminate.decontaminate(real, items)
    bad = {d for d, *_ in brute_leaks([(r.doc_id, r.text) for r in real.collect()], held)}
    assert bad and {r.doc_id for r in kept.collect()} == {r.doc_id for r in real.collect()} - bad and kept.columns == real.columns
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(real, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()


def test_question_or_answer_alone(spark):
    question = "Which of the many rivers of the northern plain carries the most water in spring?"
    answer = "It is the long river that comes down from the hills behind the town."
    items = spark.createDataFrame([(1, f"{question} {answer}"), (2, "Why so? Because.")], "item_id long, text string")
    rows = [
        (1, f"{question} Nobody has measured any of them so far, and nobody will for many more years to come, they say."), (2, f"As you know, {answer.lower()}"),
        (3, f"{question} {answer}"), (4, "Why so?"), (5, "because"), (None, f"lead {question}"), (None, "clean text"), (6, "the many rivers of the town"), (7, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"leak_id": F.lit(3), "found": F.lit("x"), "item_id": F.lit(2)})
    got = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id): r.found for r in got} == {(1, 1): "question", (2, 1): "answer", (3, 1): "item,question,answer", (None, 1): "question"}
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted((r.text or "") for r in kept.collect()) == ["", "Why so?", "because", "clean text", "the many rivers of the town"]


def test_question_and_answer():
    assert decontaminate.split_item("Is it? Yes it is.") == ("Is it? ", "Yes it is.")
    assert decontaminate.split_item("One sentence only.") == ("One sentence only.", "")
    assert decontaminate.split_item("Is it? Yes") == ("Is it? ", "Yes")


@pytest.fixture(scope="module")
def model(real):
    return language_id.train(real.filter(~language_id.held_out(F.col("doc_id"))))


def test_language_held_out_accuracy(real, model):
    got = {r.doc_id: r for r in language_id.predict(real, model).collect()}
    held = [r for r in real.filter(language_id.held_out(F.col("doc_id"))).collect()]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in held)
    assert len(held) > 20 and right / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_code_switched(real, model):
    by = {lang: next(language_id.tokens(r.text) for r in real.collect() if r.lang == lang and r.n_chars > 500) for lang in ("en", "de")}
    words = by["en"][:40] + by["de"][:40]
    labeller = language_id.Labeller(model)
    first = np.zeros(80, bool)
    first[0] = True
    marginal, _ = language_id.forward_backward(labeller.emissions(words).astype(float), first, model.transitions, model.start)
    labels = [model.languages[i] for i in marginal.argmax(axis=1)]
    assert labels[:38].count("en") >= 36 and labels[42:].count("de") >= 36


def test_language_features_of_whole_words():
    middle = lambda x: "a" * 300 + x + "b" * 300
    assert set(language_id.features(middle("xyz"))[1:]) != set(language_id.features(middle("zyx"))[1:])
    long = language_id.features("ab" * 400_000)
    assert len(long) == len(set(long[1:])) + 1 < 30


def test_language_sample_is_bounded(spark):
    """A million rows of two languages, of which a third is one document, give no more rows than asked for."""
    some = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "one and the same").otherwise(F.concat(F.lit("word "), F.col("id").cast("string"))).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
    )
    got = Counter(lang for lang, _ in language_id.sample(some, 50, 2, 10))
    assert got == {"en": 50, "de": 50}
    junk = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"), (F.col("id") % 100).cast("string").alias("lang"))
    assert len({lang for lang, _ in language_id.sample(junk, 5, 2, 10, languages=7)}) == 7


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    emit, t, s = rng.normal(size=(37, 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.zeros(37, bool)
    first[[0, 5, 6, 20]] = True
    want, pairs = np.zeros((37, 3)), np.zeros((3, 3))
    for a, b in zip([0, 5, 6, 20], [5, 6, 20, 37], strict=True):
        n = b - a
        f, g = np.zeros((n, 3)), np.ones((n, 3))
        f[0] = np.exp(s + emit[a])
        for i in range(1, n):
            f[i] = f[i - 1] @ np.exp(t) * np.exp(emit[a + i])
        for i in range(n - 2, -1, -1):
            g[i] = np.exp(t) @ (np.exp(emit[a + i + 1]) * g[i + 1])
        z = f[-1].sum()
        want[a:b] = f * g / z
        for i in range(1, n):
            pairs += f[i - 1][:, None] * np.exp(t) * (np.exp(emit[a + i]) * g[i]) / z
    for lanes in (1, 3, 256):
        got, counts = language_id.forward_backward(emit, first, t, s, lanes)
        assert np.allclose(got, want) and np.allclose(counts, pairs)


def test_language_odd(odd, none, model):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()}
    assert len(got) == odd.select("doc_id").distinct().count()
    assert all(got[i] == ("und", 0.0) for i in (3, 4, 5, 11)) and got[8][0] in model.languages
    assert language_id.predict(none, model).count() == 0
    kept = language_id.keep_identified(odd, model)
    assert kept.columns == odd.columns and not {3, 4, 5, 11} & {r.doc_id for r in kept.collect()}
    untaught = language_id.train(none)
    assert {r.lang_pred for r in language_id.predict(odd, untaught).collect()} == {"und"}
    single = language_id.train(odd.filter("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd.filter("doc_id = 1"), single).collect()} == {("en", 1.0)}


def brute_urls(rows, links):
    """(page_id, url) rows and (source, target) links -> page_id -> (host, path, rule, verdict)."""

    def parts(url):
        if url is None or "://" not in url:
            return None, "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return rest, host.translate(LOW), re.match(r"[^?#]*", rest[len(host) :])[0]

    def rule(url):
        _, host, path = parts(url)
        fits = []
        for verdict, r in url_filter.RULES:
            h, _, p = r.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(r), verdict, r))
        return max(fits)[1:] if fits else (None, None)

    def node(url):
        rest, host, path = parts(url)
        if rest is None:
            return None
        query = rest.split("#")[0].partition("?")[2]
        kept = "&".join(p for p in query.split("&") if p and not re.match(r"utm_|fbclid=|gclid=", p))
        return re.sub(":(80|443)$", "", host) + (path or "/") + (f"?{kept}" if kept else "")

    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    said = {}
    for a, b in links:
        parent[find(node(a))] = find(node(b))
    for u in [u for _, u in rows] + [b for _, b in links]:
        if node(u) is not None and rule(u)[0]:
            said.setdefault(find(node(u)), set()).add(rule(u)[0])
    out = {}
    for page, url in rows:
        verdict, name = rule(url)
        heard = said.get(find(node(url)), set()) if node(url) is not None else set()
        out[page] = (*parts(url)[1:], name, verdict or ("allow" if "allow" in heard else "block" if "block" in heard else "allow"))
    return out


def test_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    assert {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages).collect()} == brute_urls(rows, [])


def test_url_aliases(spark):
    link = lambda u: f'<html><head><!-- <link rel="canonical" href="http://no.com/en/"> --><LINK href="{u}" rel=\'canonical\'></head>'
    rows = [
        (1, "http://a.net/x", link("https://B.com/en/9")),  # alias of a blocked URL
        (2, "http://c.net/y?utm_source=q#z", '<meta http-equiv="refresh" content="0; url=http://a.net/x">'),  # by two steps
        (3, "https://c.net/y", "plain"),  # the same node as 2
        (4, "http://d.net/w", link("//example.com/en/7")),  # explicit allow
        (5, "http://e.net/v", link("http://d.net/w") + '<link rel=canonical href="http://b.com/en/1">'),  # allow has precedence
        (6, "http://b.com/en/1", None), (7, None, ""), (8, "no-scheme", link("/q")), (9, "HTTP://X.Org:80/es/", None), (10, "http://f.net", link("rel?a=1&amp;b=2")),
        (11, "http://f.net/rel?b=2&a=1", ""), (12, "http://f.net/rel?a=1&b=2", link("http://z.org/es/1")), (13, "http://com/en/", ""), (13, "http://com/en/", ""),
    ]
    links = [("http://a.net/x", "https://B.com/en/9"), ("http://c.net/y", "http://a.net/x"), ("http://d.net/w", "http://example.com/en/7"), ("http://e.net/v", "http://d.net/w"),
             ("http://e.net/v", "http://b.com/en/1"), ("http://f.net", "http://f.net/rel?a=1&b=2"), ("http://f.net/rel?a=1&b=2", "http://z.org/es/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("x")).withColumn("component", F.lit("y"))
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    want = brute_urls([r[:2] for r in rows], links)
    assert {r.page_id: tuple(r)[1:] for r in got} == want
    assert [want[i][3] for i in (1, 2, 3, 4, 5, 10, 11, 12)] == ["block", "block", "block", "allow", "allow", "block", "allow", "block"]
    hub = spark.createDataFrame([(f"http://h{i}.net/", "http://t.com/en/x") for i in range(300)], "source string, target string")
    asked = spark.createDataFrame([(i, f"https://h{i}.net/", None) for i in range(300)], "page_id long, url string, html string")
    assert {r.verdict for r in url_filter.judge(asked, hub).collect()} == {"block"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_language_null_ids_of_one_length(spark):
    """The draw goes by id and text, so null ids of one length are drawn like others."""
    rows = [(None, f"{w} {w}{w} {i:05}", lang) for i in range(3000) for w, lang in (("alpha", "aa"), ("gamma", "bb"))]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {lang for lang, _ in language_id.sample(labelled, 20, 2, 5)} == {"aa", "bb"}


def test_language_memory_is_words_times_labels():
    import tracemalloc

    n, k = 60_000, 40
    rng = np.random.default_rng(0)
    emit, first = rng.normal(size=(n, k)), rng.random(n) < 0.01
    tracemalloc.start()
    language_id.forward_backward(emit, first, rng.normal(size=(k, k)), rng.normal(size=k))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * n * k * 8
