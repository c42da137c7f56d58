"""Reading by file, only what is new, prefixes, phases, defaults and placeholders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.plans.registry import query
from seatloom.runtime import table
from seatloom.sources import files

SCHEDULE = (
    '{"AY202324T2": [["2024-01-05T12:00:00", "Round 1 Window 1", "R1W1"], ["2024-01-12T12:00:00", "Round 1A Window 1", "R1AW1"]], '
    '"AY202425T1": [["2024-07-01T09:30:00", "Round 1 Window 1", "R1W1"]], "AY202425T2": []}'
)


@query("""
SELECT 'nation' AS source_file, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def multi_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    # columns that a file lacks are null
    rows = files.scan(spark, [f"{sf}/{n}.parquet" for n in ("nation", "region", "supplier")], "n_nationkey int, r_regionkey int, s_suppkey bigint")
    return rows.groupBy("source_file").agg(F.count("*").alias("n"))


@query(f"""
WITH j AS (SELECT '{SCHEDULE}'::JSON AS j), k AS (SELECT j, unnest(json_keys(j)) AS term FROM j),
e AS (SELECT term, CAST(json_extract(j, '$.' || term) AS VARCHAR[][]) AS es FROM k),
x AS (SELECT term, i - 1 AS seq, es[i] AS e FROM (SELECT term, es, unnest(range(1, len(es) + 1)) AS i FROM e))
SELECT term, seq::INTEGER AS seq, e[1]::TIMESTAMP AS at, e[2] AS window, e[3] AS abbreviation FROM x""")
def schedule_json(spark: SparkSession, sf: str) -> DataFrame:
    return files.schedule(spark.createDataFrame([(SCHEDULE,), ("not json",)], "text string"), "text")


@query("""
SELECT page_id, url FROM pages WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'view' AND user_id = page_id)""")
def incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "events").filter("event_type = 'view'").select(F.col("user_id").alias("page_id"))
    return files.unseen(table(spark, sf, "pages").select("page_id", "url"), done, ["page_id"])


@query("""
WITH s AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events),
t AS (SELECT user_id, max(seq) AS target FROM s WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, event_id, seq::INTEGER AS seq FROM s JOIN t USING (user_id) WHERE seq <= target AND event_type <> 'error'""")
def prefix_until_target(spark: SparkSession, sf: str) -> DataFrame:
    # numbering and target share one partitioning by user
    own = Window.partitionBy("user_id")
    seq = table(spark, sf, "events").withColumn("seq", F.row_number().over(own.orderBy("ts", "event_id")))
    seq = seq.withColumn("target", F.max(F.when(F.col("event_type") == "purchase", F.col("seq"))).over(own))
    return seq.filter((F.col("seq") <= F.col("target")) & (F.col("event_type") != "error")).select("user_id", "event_id", "seq")


@query("""
SELECT o_custkey, count(*) AS n, max(CAST(left(o_orderpriority, 1) AS INTEGER)) AS phase FROM orders
GROUP BY o_custkey HAVING count(*) <= 14 AND max(CAST(left(o_orderpriority, 1) AS INTEGER)) < 5""")
def phase_not_reached(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max(F.left("o_orderpriority", F.lit(1)).cast("int")).alias("phase"))
    return g.filter("n <= 14 AND phase < 5")


@query("""
SELECT l_orderkey, l_linenumber, coalesce(p_brand, 'PENDING_' || l_partkey || '_' || l_linenumber) AS brand, coalesce(p_size, 0) AS size
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey""")
def map_default(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").filter("p_size < 40").select("p_partkey", "p_brand", "p_size")
    l = table(spark, sf, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    pending = F.concat_ws("_", F.lit("PENDING"), "l_partkey", "l_linenumber")
    return l.select("l_orderkey", "l_linenumber", F.coalesce("p_brand", pending).alias("brand"), F.coalesce("p_size", F.lit(0)).alias("size"))


@query("""
SELECT coalesce(nullif(o_orderstatus, 'P'), 'Unknown') AS status, l_linenumber, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def placeholder_fill(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("Unknown")).alias("status"))
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("status", "l_linenumber").agg(F.count("*").alias("n"))
