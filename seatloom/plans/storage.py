"""Sinks and sources on the tables' rows: what is written is read again. Everything is written below the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.operators import tables as op
from seatloom.plans.registry import query
from seatloom.runtime import scratch_dir, table
from seatloom.sources import arrivals, files, sinks, workbooks
from seatloom.sources.versions import Versions


def place(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/seatloom-{name}-{uuid.uuid4().hex}"


@query("""
SELECT c_custkey, greatest(c_acctbal, 0.0) AS c_acctbal, CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END::BIGINT AS version, 'N' || c_nationkey AS nation FROM customer""")
def committed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and nations as one version, negative balances mended by the next; its label is committed once."""
    log, c = Versions(spark, place(spark, "versions")), table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("nation"))
    log.commit([("nations", "new", nations), ("customers", "new", c)], "first")
    for _ in range(2):
        log.commit([("customers", "updated", c.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0)))], "second")
    latest = op.first_per_key(log.read("customers"), ["c_custkey"], [F.desc("_version")])
    return latest.join(log.read("nations").select("n_nationkey", "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_acctbal", F.col("_version").alias("version"), "nation")


@query("""
SELECT s_suppkey, s_name, s_acctbal, n_name, s_suppkey AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def workbook_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Two sheets of one book, written in one job and read by ranges of rows."""
    path = f"{place(spark, 'book')}.xlsx"
    workbooks.write_book({"suppliers": table(spark, sf, "supplier").orderBy("s_suppkey"), "nations": table(spark, sf, "nation")}, path)
    s = workbooks.read_sheet(spark, path, "suppliers", "s_suppkey long, s_name string, s_nationkey int, s_acctbal double, row long", rows=40)
    n = workbooks.read_sheet(spark, path, "nations", "n_nationkey int, n_name string")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "s_acctbal", "n_name", F.col("row").alias("place"))


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END::BIGINT AS version FROM orders""")
def arrived_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that arrive in files: a run takes the first, the next the new ones, a third finds nothing."""
    folder, target, checkpoint = (place(spark, n) for n in ("arriving", "arrived", "checkpoint"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    take = lambda: arrivals.take(spark, folder, "o_orderkey long, o_orderstatus string, o_totalprice double", target, "orders", checkpoint)
    for part in ("o_orderstatus <> 'P'", "o_orderstatus = 'P'", "false"):
        o.filter(part).write.mode("append").parquet(folder)
        take()
    return arrivals.latest(spark, target, "orders", ["o_orderkey"], number="version").select("o_orderkey", "o_totalprice", "version")


@query("""
SELECT event_id, '["' || event_type || '"]' AS kinds, replace(ts::VARCHAR, ' ', 'T')[1:19] AS ts, props FROM events""")
def csv_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Events as CSV of fixed columns, lists as JSON, and read by schema; a file without a required column, or none, gives no rows."""
    path = place(spark, "csv")
    e = table(spark, sf, "events").select("event_id", F.array("event_type").alias("kinds"), F.col("ts").cast("timestamp").alias("ts"), "props", "value")
    sinks.write_csv(e, path, ["event_id", "kinds", "ts", "props"])
    schema = "event_id long, kinds string, ts string, props string"
    rows = [files.read_csv(spark, p, schema, need) for p, need in ((path, ["event_id"]), (path, ["value"]), (f"{path}-none", []))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""
SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, CASE WHEN o_orderstatus = 'P' THEN 2 * count(*) ELSE 1 END::BIGINT AS n FROM orders GROUP BY o_custkey, o_orderstatus""")
def appended_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows appended twice: a key that is there is not appended again, a key with a null always is."""
    path = place(spark, "appended")
    rows = table(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    for _ in range(2):
        sinks.append_new(rows, path, ["o_custkey", "status"])
    return spark.read.parquet(path).groupBy("o_custkey", "status").agg(F.count("*").alias("n"))
