"""Exact dedup against brute force: copies, hot groups, weak digests, odd rows."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from seatloom.llm import exact_dedup

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows):
    """(doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(LOW)].append(d)
    out = []
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep, sha = max(known, default=None), hashlib.sha256(text.encode()).hexdigest()
        first = ids.index(keep)
        out += [(d, keep, len(ids), i == first, sha) for i, d in enumerate(ids)]
    return sorted(out, key=str)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def result(docs, **more):
    return sorted((tuple(r) for r in exact_dedup.groups(docs, **more).collect()), key=str)


@pytest.mark.parametrize("more", [{}, {"hot_share": 3}, {"hot_share": 1 << 40}, {"digest": lambda t: F.length(t) % 7}])
def test_groups(real, odd, none, more):
    for docs in (real, odd, none):
        assert result(docs, **more) == brute(rows_of(docs))


def test_hot_group_over_many_tasks(spark):
    rows = [(i, "Ünchanged É HOT" if i % 3 == 0 else f"Text {i // 2}") for i in range(900)] + [(None, "ünchanged"), (None, "hot"), (7, "HOT"), (7, "hoT")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(23)
    assert result(docs) == result(docs, hot_share=5) == brute(rows)
    plan = exact_dedup.contents(docs.selectExpr("text AS key", "text AS norm", "doc_id"), docs.selectExpr("text AS key").limit(1))
    assert plan.agg(F.sum("group_size")).first()[0] == len(rows)


def test_dedup_keeps_columns_and_one_of_repeats(odd, none):
    got = exact_dedup.dedup(odd)
    assert got.columns == odd.columns
    want = sorted(((d, k) for d, k, _, kept, _ in brute(rows_of(odd)) if kept), key=str)
    assert sorted(((r.doc_id, r.doc_id) for r in got.collect()), key=str) == want
    assert exact_dedup.dedup(none).count() == 0


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted((tuple(r) for r in con.sql(exact_dedup.ORACLE_SQL).fetchall()), key=str)
    assert result(spark.read.parquet(f"{sf_dir}/documents.parquet")) == want
