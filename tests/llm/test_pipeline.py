"""The corpus pipeline against its stages' brute force, and odd documents through it."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seatloom.llm import secret_scan, shingle_dedup


def test_stage_by_stage(spark, real, sf_dir):
    docs, seen = real, [real.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == real.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        seen.append(out.count())
        docs = out
    assert seen == sorted(seen, reverse=True) and seen[3] == seen[4] and seen[1] >= 0.9 * seen[0]
    assert all(not r.base for r in secret_scan.scan(docs).collect())
    whole = corpus_pipeline.run(spark, sf_dir)
    assert {(r.doc_id, r.taken) for r in whole.collect()} == {(r.doc_id, r.taken) for r in docs.collect()}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_documents(spark, odd, none, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert {c for c in odd.columns if c not in ("size", "taken")} <= set(stage(spark, odd, sf_dir).columns)
    stage(spark, odd, sf_dir).count()
    assert stage(spark, none, sf_dir).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_clashing_names(spark, odd, sf_dir, name):
    """Columns named like those an operator adds stay what they are."""
    names = ["leak_id", "item_id", "found", "row_key", "gone_key", "kept_key", "twice_key", "fp", "bands", "m_size", "m_key", "c_size", "c_range", "base", "spans", "candidates", "passed", "whole", "key", "lang_pred"]
    docs = odd.withColumns({n: F.lit("own") for n in names})
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    assert {r[n] for r in rows for n in names} == {"own"}
    assert len(rows) == dict(corpus_pipeline.STAGES)[name](spark, odd, sf_dir).count()


def jaccard(a, b):
    x, y = (set(zip(*(w[i:] for i in range(5)), strict=False)) for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_near_dedup_keeps_one_of_planted_near_copies(spark, sf_dir):
    rng, rows, pairs = random.Random(11), [], []
    for n, changed in [(200, 1), (100, 1), (500, 3), (200, 3), (200, 4)] * 12:
        words = [f"w{rng.randrange(50_000)}" for _ in range(n)]
        copy = list(words)
        for at in rng.sample(range(n), changed):
            copy[at] = "changed"
        pairs.append((2 * len(pairs), " ".join(words), " ".join(copy)))
        rows += [(pairs[-1][0], pairs[-1][1], "en", "a", 1), (pairs[-1][0] + 1, pairs[-1][2], "en", "a", 1)]
    near = {i for i, a, b in pairs if jaccard(a, b) >= 0.8}
    assert len(near) > 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, sf_dir).collect()}
    assert kept == {r[0] for r in rows} - {i + 1 for i in near}


def test_near_dedup_by_chunks(spark):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join("x" if k == at else w for k, w in enumerate(base)) for at in rng.sample(range(300), 60)]
    chain = [" ".join(f"c{k}" for k in range(8 * i, 8 * i + 200)) for i in range(20)]
    rows = list(enumerate(texts + chain)) + [(500, "alone"), (501, ""), (502, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cut in ({}, {"chunk": 7}, {"max_bits": 0}):
        assert {r.doc_id for r in shingle_dedup.dedup(docs, **cut).collect()} == {0, 60, 500, 501}
