"""Operators on small tables; every registered query with SQL against DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from seatloom.operators import names, tables
from seatloom.operators.reconcile import reconcile
from seatloom.plans import catalog

EXISTING = "term string, boss_id long, class_id string, professor_id string"
INCOMING = "term string, boss_id long, position int, professor_id string"


@pytest.mark.parametrize(
    ("old", "new", "want"),
    [
        ([], ["A"], [(None, "A", "create")]),
        ([("c1", "A")], ["A", "B"], [("c1", "A", "keep"), (None, "B", "create")]),
        ([("c1", "A"), ("c2", "B")], [None], [("c1", None, "update"), ("c2", None, "deactivate")]),
        ([("c1", "A")], ["B"], [("c1", "B", "update")]),
        ([("c1", None)], ["B"], [("c1", "B", "update")]),
        ([("c1", "A"), ("c2", None)], ["B"], [("c1", None, "deactivate"), ("c2", "B", "update")]),
        ([("c1", "A")], ["B", "A"], [("c1", "B", "update"), (None, "A", "create")]),  # an earlier professor takes a class
    ],
)
def test_reconcile(spark, old, new, want):
    e = spark.createDataFrame([("T", 1, c, p) for c, p in old] + [("T", 2, "other", "Z")], EXISTING)
    i = spark.createDataFrame([("T", 1, n, p) for n, p in enumerate(new)], INCOMING)
    got = [(r.class_id, r.professor_id, r.action) for r in reconcile(e, i).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_greedy_split(spark):
    known = spark.createDataFrame([("LEE, ANN",), ("Bob Tan",), ("ANN",)], "alias string")
    rows = spark.createDataFrame([(1, "Lee, Ann, Bob Tan"), (2, "Bob Tan, Jr"), (3, "New Person, lee, ann"), (4, ""), (5, None), (6, "Solo")], "k int, names string")
    got = {r.k: r.people for r in names.split_names(rows, "k", "names", known, "alias").collect()}
    assert got == {1: ["Lee, Ann", "Bob Tan"], 2: ["Bob Tan, Jr"], 3: ["New Person", "lee, ann"], 4: [], 5: [], 6: ["Solo"]}


def test_overlay_first_and_runs(spark):
    snap, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    for _ in range(2):  # a second upsert changes nothing
        snap = tables.overlay(snap, new, ["k"], [F.col("v")])
    assert sorted(map(tuple, snap.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    e = spark.createDataFrame([(i, f) for i, f in enumerate([1, 1, 0, 1, 0, 0, 1, 1, 1])], "i int, f int")
    got = [r.run for r in tables.runs(e, [], [F.col("i")], F.col("f") == 1, "run").orderBy("i").collect()]
    assert got == [1, 2, 0, 1, 0, 0, 1, 2, 3]


def test_as_of(spark):
    s = spark.createDataFrame([(10, "w1"), (20, "w2")], "t int, name string")
    got = tables.as_of(spark.createDataFrame([(5,), (10,), (25,)], "at int"), "at", s, "t", "name").orderBy("at").collect()
    assert [(r.current, r.previous) for r in got] == [("w1", None), ("w2", "w1"), (None, "w2")]


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, sf_dir)
    result = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in r) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr) == want
