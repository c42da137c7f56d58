"""Substring dedup and SimHash near-dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seatloom.llm import graph, simhash, substring_dedup

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return (text or "").encode().split()


def brute_substrings(rows, width=20):
    """(doc_id, text) -> Counter of (doc_id, n_words, n_removed, sha256)."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - width + 1):
            k, at = tuple(w[i : i + width]), (doc_id is not None, doc_id or 0, i)
            first[k] = min(first.get(k, at), at)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < (doc_id is not None, doc_id or 0, i):
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substring_dedup(spark, odd, none, real):
    for docs in (odd, real):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        for max_bits in (substring_dedup.MAX_BITS, 0):  # by bit sets, by joins
            got = Counter(tuple(r) for r in substring_dedup.digest(substring_dedup.dedup(docs, max_bits=max_bits)).collect())
            assert got == brute_substrings(rows)
    assert substring_dedup.dedup(none).count() == 0 and substring_dedup.dedup(none, max_bits=0).count() == 0


def test_free_paths_are_compacted(spark):
    """A passage that stands in several texts is a few pieces, not one a path; a full bit set only adds pieces."""
    passage = " ".join(f"p{i}" for i in range(2000))
    docs = spark.createDataFrame([(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(4)] + [(9, " ".join(f"q{i}" for i in range(3000)))], "doc_id long, text string")
    rows = docs.select("doc_id", "text", substring_dedup.text_key())
    by_anchor = substring_dedup.anchors(docs, 20, 8)
    few = substring_dedup.pieces(rows, substring_dedup.facts_by_sets(by_anchor, substring_dedup.bits_for(by_anchor.count())), 20, 8).filter("doc_id < 9")
    assert few.count() < 4 * 60 and few.agg({"n_edges": "max"}).first()[0] > 1900
    full = substring_dedup.pieces(rows, substring_dedup.facts_by_sets(by_anchor, 64), 20, 8)
    assert full.agg({"n_edges": "sum"}).first()[0] == 4 * (2004 - 19) + 3000 - 19


def test_substring_dedup_periodic_and_branching(spark):
    texts = ["a b " * 60, "a b " * 45 + "c", " ".join("xyz"[i * i % 3] for i in range(200)), "p " * 100, " ".join(map(str, range(50))), " ".join(map(str, range(10, 45))) + " q"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for max_bits in (substring_dedup.MAX_BITS, 0):
        assert Counter(tuple(r) for r in substring_dedup.digest(substring_dedup.dedup(docs, max_bits=max_bits)).collect()) == brute_substrings(rows)


def test_substring_dedup_rows_of_one_id(spark):
    passage = " ".join(f"r{i}" for i in range(30))
    long = " ".join(f"u{i}" for i in range(200)) + f" {passage} and {passage}"
    rows = [(None, long), (None, "short text of null id"), (None, " ".join(f"v{i}" for i in range(240))), (3, f"{passage} x"), (3, "tiny"), (3, f"lead {passage}"), (3, f"lead {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for max_bits in (substring_dedup.MAX_BITS, 0):
        assert Counter(tuple(r) for r in substring_dedup.digest(substring_dedup.dedup(docs, max_bits=max_bits)).collect()) == brute_substrings(rows)


def brute_print(text):
    parts = (text or "").translate(LOW).encode().split()
    if not parts:
        return 0
    grams = [b" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_clusters(rows):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_simhash(spark, odd, none, real):
    for docs in (odd, real):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want = brute_clusters(rows)
        for sizes in ({}, {"leaf": 4}, {"shard": 0.001}):
            assert Counter(tuple(r) for r in simhash.digest(simhash.clusters(docs, **sizes)).collect()) == want
    assert simhash.clusters(none).count() == 0


def test_simhash_dedup_keeps_one_row_a_component(odd, none, real):
    for docs in (odd, real):
        got = simhash.dedup(docs)
        assert got.columns == docs.columns
        want = {(d, c) for (d, _, c), _ in brute_clusters([(r.doc_id, r.text) for r in docs.collect()]).items()}
        ids = [r.doc_id for r in got.collect()]
        assert Counter(i for i in ids if i is not None) == Counter({c for _, c in want if c is not None})
    assert simhash.dedup(none).count() == 0


@pytest.mark.parametrize(("n", "choices"), [(10, 4), (100_000_000, 10), (200_000_000_000, 20)])
def test_shards_keep_their_size(n, choices):
    found, rng = simhash.masks(n, 3), random.Random(4)
    assert len(found) == choices and n / 2 ** min(m.bit_count() for m in found) < 2 * simhash.SHARD
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in found)


def test_dedup_of_clashing_names(spark):
    names = ["gone_key", "kept_key", "twice_key", "dedup_key", "row_key", "fp", "root", "l_fp", "none"]
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "e"), (3, "e")], "doc_id long, text string").withColumns({n: F.lit(n) for n in names})
    got = simhash.dedup(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d", *names), (3, "e", *names)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 12) - 1), max_size=40, unique=True))
def test_bk_tree_links_span(values):
    links = simhash.spanning_links(values[::2], values[1::2], 2)
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert set(tree.near(v, 2)) == {o for o in values if (o ^ v).bit_count() <= 2}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
