"""Boosted trees and scans of hot groups on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.domain import models
from seatloom.operators import boosting, scans
from seatloom.plans.registry import query
from seatloom.runtime import materialise, table

LINES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("""
WITH x AS (SELECT l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_linenumber::DOUBLE AS f3, avg(l_extendedprice) OVER () - l_extendedprice AS g FROM lineitem),
c AS (SELECT g, unnest([0, 1, 2, 3]) AS feature, unnest([f0, f1, f2, f3]) AS v FROM x),
h AS (SELECT feature, v, sum(g) AS g, count(*) AS n FROM c GROUP BY ALL),
r AS (SELECT feature, v, sum(g) OVER a AS lg, sum(n) OVER a AS ln, sum(g) OVER e AS ag, sum(n) OVER e AS an FROM h WINDOW a AS (PARTITION BY feature ORDER BY v), e AS (PARTITION BY feature)),
s1 AS (SELECT feature, v FROM r WHERE ln < an ORDER BY round(lg * lg / (ln + 5.0::DOUBLE) + (ag - lg) * (ag - lg) / (an - ln + 5.0::DOUBLE), 3) DESC, feature, v LIMIT 1),
y AS (SELECT x.*, (CASE s1.feature WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END > s1.v)::INTEGER AS leaf FROM x, s1),
c2 AS (SELECT g, leaf, unnest([0, 1, 2, 3]) AS feature, unnest([f0, f1, f2, f3]) AS v FROM y),
grid AS (SELECT DISTINCT feature, v FROM h), leaves AS (SELECT DISTINCT leaf FROM y),
h2 AS (SELECT leaf, feature, v, coalesce(sum(c2.g), 0) AS g, count(c2.g) AS n FROM grid CROSS JOIN leaves LEFT JOIN c2 USING (leaf, feature, v) GROUP BY ALL),
r2 AS (SELECT leaf, feature, v, sum(g) OVER a AS lg, sum(n) OVER a AS ln, sum(g) OVER e AS ag, sum(n) OVER e AS an FROM h2 WINDOW a AS (PARTITION BY leaf, feature ORDER BY v), e AS (PARTITION BY leaf, feature)),
t2 AS (SELECT feature, v, sum(lg * lg / (ln + 5.0::DOUBLE) + (ag - lg) * (ag - lg) / (an - ln + 5.0::DOUBLE)) AS score, bool_or(ln > 0) AND bool_or(ln < an) AS real FROM r2 GROUP BY ALL),
s2 AS (SELECT feature, v FROM t2 WHERE real ORDER BY round(score, 3) DESC, feature, v LIMIT 1),
z AS (SELECT y.g, y.leaf + 2 * (CASE s2.feature WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END > s2.v)::INTEGER AS leaf FROM y, s2)
SELECT leaf::BIGINT AS leaf, count(*) AS n, round(-sum(g) / (count(*) + 5.0::DOUBLE), 4) AS step, (SELECT round(v, 6) FROM s1) AS first_at, (SELECT round(v, 6) FROM s2) AS second_at,
       (SELECT feature FROM s1)::INTEGER AS first_feature, (SELECT feature FROM s2)::INTEGER AS second_feature FROM z GROUP BY leaf""")
def boosted_tree(spark: SparkSession, sf: str) -> DataFrame:
    """One symmetric tree of two questions on prices: its leaves."""
    rows = table(spark, sf, "lineitem").select(*LINES, "l_extendedprice")
    model = boosting.fit(rows, LINES, [], "l_extendedprice", boosting.Params(trees=1, depth=2, rate=1.0))
    tree, price = model.trees[0], model.base
    asked = [(f, model.cuts[f][t - 1]) for f, t in zip(tree.features, tree.thresholds, strict=True)]
    leaf = sum(F.when(F.col(LINES[f]).cast("double") > v, 1 << i).otherwise(0) for i, (f, v) in enumerate(asked))
    counted = model.transform(rows).groupBy(leaf.cast("long").alias("leaf")).agg(F.count("*").alias("n"), F.round(F.max(F.col("prediction") - price), 4).alias("step"))
    (f1, v1), (f2, v2) = asked
    return counted.select("*", F.lit(round(v1, 6)).alias("first_at"), F.lit(round(v2, 6)).alias("second_at"), F.lit(f1).alias("first_feature"), F.lit(f2).alias("second_feature"))


@query("""
WITH e AS (SELECT o_orderkey, unnest([0, 1]) AS feature, unnest([o_orderpriority, o_orderstatus]) AS category, o_totalprice, md5(o_orderkey::VARCHAR) AS k FROM orders),
t AS (SELECT o_orderkey, feature, coalesce(sum(o_totalprice) OVER w, 0) AS total, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY feature, category ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT avg(o_totalprice) AS mean FROM orders)
SELECT o_orderkey, round(max(CASE WHEN feature = 0 THEN (total + mean) / (n + 1) END), 3) AS priority_mean, round(max(CASE WHEN feature = 1 THEN (total + mean) / (n + 1) END), 3) AS status_mean FROM t, m GROUP BY o_orderkey""")
def ordered_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Categories as mean prices of earlier orders in a random order; five and three groups hold all rows."""
    o = table(spark, sf, "orders").withColumn("k", F.md5(F.col("o_orderkey").cast("string")))
    mean = o.agg(F.avg("o_totalprice")).first()[0] or 0.0
    s = boosting.ordered_statistics(o, "o_orderkey", ["k"], ["o_orderpriority", "o_orderstatus"], "o_totalprice", mean, 1.0)
    return s.select("o_orderkey", F.round(F.get("stats", F.lit(0)), 3).alias("priority_mean"), F.round(F.get("stats", F.lit(1)), 3).alias("status_mean"))


@query()
def boosted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier and two regressors trained on earlier years, stopped by and scored on the last."""
    rows = materialise(models.training_rows(spark, sf), "market-rows")  # read for each model and to be scored
    trained = models.train(rows, models.small(), test_year=1998)
    return trained.score(rows.filter("acad_year_start = 1998"), "o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER w AS earlier_quantity, count(*) OVER w AS earlier_rows, round(max(l_extendedprice) OVER w, 2) AS earlier_top, round(lag(l_extendedprice) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice), 2) AS price_before
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def hot_group_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Running sum, count, extreme and row before in three groups that hold all rows."""
    l, order = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    before = F.struct(*order)
    out = scans.running(l, ["l_returnflag"], order, {"total": ("sum", F.col("l_quantity")), "n": ("sum", F.lit(1)), "top": ("max", F.col("l_extendedprice")), "last": ("max", before)})
    return out.select("l_orderkey", "l_linenumber", F.col("total").alias("earlier_quantity"), F.coalesce("n", F.lit(0)).cast("long").alias("earlier_rows"), F.round("top", 2).alias("earlier_top"), F.round("last.l_extendedprice", 2).alias("price_before"))


@query("""
WITH f AS (SELECT event_type, event_id, ts, (value > 50)::INTEGER AS f FROM events),
i AS (SELECT *, sum(1 - f) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS island FROM f)
SELECT event_id, sum(f) OVER (PARTITION BY event_type, island ORDER BY ts, event_id)::BIGINT AS run FROM i""")
def hot_group_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of high values within event types, of which there are few."""
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    return scans.runs(e, ["event_type"], ["ts", "event_id"], F.col("value") > 50, "run").select("event_id", "run")
