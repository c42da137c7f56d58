"""Ranked lexical search against brute force and its SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from seatloom.llm import ranked_search

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def terms(text):
    return [t.translate(LOW) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=50):
    """(id, text) of documents and items -> sorted (item_id, rank, doc_id, score)."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(x for *_, x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for d, c, length in counted:
            m = 100 - 50 + (50 * length * n) // total
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(item, i, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def pairs_of(table, name):
    return [(r[0], r[1]) for r in table.select(name, "text").collect()]


def result(*args, **more):
    return sorted((tuple(r) for r in ranked_search.search(*args, **more).collect()), key=str)


@pytest.mark.parametrize("cut", [{}, {"block_terms": 100, "chunk": 300, "pairs": 50}, {"k": 3, "pairs": 1}])
def test_search(spark, sf_dir, real, odd, none, cut):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for docs in (real, odd):
        assert result(docs, items, **cut) == brute(pairs_of(docs, "doc_id"), pairs_of(items, "item_id"), cut.get("k", 50))
    assert result(none, items, **cut) == []
    assert result(real, items.limit(0), **cut) == []


def test_ties_repeats_and_nulls(spark):
    rows = [(i, "Alpha beta") for i in range(120)] + [(7, "alpha BETA"), (None, "alpha beta"), (None, None), (500, ""), (501, "éa x-ray ÉA Éa"), (-3, "alpha beta")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    asked = [(1, "alpha? alpha"), (1, "gamma beta"), (None, "éa"), (2, None), (3, "nowhere"), (4, "ray X"), (None, "ALPHA")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    for cut in ({}, {"k": 5, "pairs": 7, "chunk": 3}):
        assert result(docs, items, **cut) == brute(rows, asked, cut.get("k", 50))


def test_radix_sums():
    rng = np.random.default_rng(5)
    for high in (1, 3, 1 << 16, 1 << 40, (1 << 64) - 1):
        keys = rng.integers(0, high, 5000, dtype=np.uint64, endpoint=True)
        impacts = rng.integers(1, 1 << 40, 5000)
        assert (keys[ranked_search.radix_order(keys)] == np.sort(keys)).all()
        want = {}
        for key, x in zip(keys.tolist(), impacts.tolist(), strict=True):
            want[key] = want.get(key, 0) + x
        got = ranked_search.summed(keys, impacts)
        assert dict(zip(got[0].tolist(), got[1].tolist(), strict=True)) == want


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = sorted((tuple(r) for r in con.sql(ranked_search.ORACLE_SQL).fetchall()), key=str)
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    assert result(docs, items) == want
