"""Incremental runs: new files only, nothing twice, failures taken up again."""

import pytest
from pyspark.sql import functions as F

from seatloom.sources import arrivals
from seatloom.sources.versions import Versions

SCHEMA = "k int, v string"


def test_new_files_only_and_once(spark, tmp_path):
    folder, target, checkpoint = (f"file://{tmp_path / n}" for n in ("in", "db", "checkpoint"))
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    run = lambda **more: arrivals.take(spark, folder, SCHEMA, target, "t", checkpoint, **more)
    put([(1, "a"), (2, "b")])
    assert run() == [1] and run() == []
    put([(2, "c")])
    put([(3, "d")])
    assert run(files_per_batch=1) == [2, 3]
    got = {r.k: r.v for r in arrivals.latest(spark, target, "t", ["k"]).collect()}
    assert got == {1: "a", 2: "c", 3: "d"}
    assert Versions(spark, target).read("t").select("source_file").distinct().count() == 3
    assert arrivals.latest(spark, target, "other", ["k"]) is None


def test_failures_are_taken_up_again(spark, tmp_path):
    """Failure before the commit, and between the commit and the end of the batch."""
    folder, target, checkpoint = (f"file://{tmp_path / n}" for n in ("in", "db", "checkpoint"))
    spark.createDataFrame([(1, "a")], SCHEMA).coalesce(1).write.parquet(folder)
    run = lambda **more: arrivals.take(spark, folder, SCHEMA, target, "t", checkpoint, **more)

    def broken(rows):
        raise ValueError("lost before")

    with pytest.raises(Exception, match="lost before"):
        run(prepare=broken)
    assert Versions(spark, target).latest() == 0
    commit = Versions.commit

    def late(self, *args, **more):
        commit(self, *args, **more)
        raise ValueError("lost after")

    Versions.commit = late
    try:
        with pytest.raises(Exception, match="lost after"):
            run()
    finally:
        Versions.commit = commit
    assert run() == [] and Versions(spark, target).latest() == 1
    assert [tuple(r) for r in Versions(spark, target).read("t").select("k", "v").collect()] == [(1, "a")]


def test_prepared_rows(spark, tmp_path):
    """Rows that do not fit the schema are left to ``prepare``."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("k,v\n1,a\nbad,b\n2,\n")
    folder, target, checkpoint = (f"file://{tmp_path / n}" for n in ("in", "db", "checkpoint"))
    good = lambda rows: rows.filter(F.col("k").isNotNull()).withColumn("v", F.coalesce("v", F.lit("-")))
    assert arrivals.take(spark, folder, SCHEMA, target, "t", checkpoint, "csv", options={"header": "true"}, prepare=good) == [1]
    assert sorted((r.k, r.v, r.source_file) for r in Versions(spark, target).read("t").collect()) == [(1, "a", "x.csv"), (2, "-", "x.csv")]
