"""Model-side statistics: uncertainty, metrics, multipliers, associations, features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.operators import ranks
from seatloom.plans.registry import query
from seatloom.runtime import table


def r6(c: Column) -> Column:
    return F.round(c, 6)


@query("""
WITH p AS (SELECT event_id, least(greatest(value / 200.0::DOUBLE, 0), 1) AS p FROM events),
c AS (SELECT event_id, p, 1 - (-(p * ln(p + 1e-10::DOUBLE)) - ((1 - p) * ln(1 - p + 1e-10::DOUBLE))) / ln(2.0::DOUBLE) AS conf FROM p)
SELECT event_id, round(conf, 6) AS conf, CASE WHEN conf >= 0.9 THEN 'Very High' WHEN conf >= 0.7 THEN 'High' WHEN conf >= 0.5 THEN 'Medium' WHEN conf >= 0.3 THEN 'Low' ELSE 'Very Low' END AS level FROM c""")
def entropy_confidence(spark: SparkSession, sf: str) -> DataFrame:
    p = F.least(F.greatest(F.col("value") / 200.0, F.lit(0.0)), F.lit(1.0))
    e = table(spark, sf, "events").select("event_id", T.entropy_confidence(F.array(p, 1 - p)).alias("c"))
    c = F.col("c")
    level = F.when(c >= 0.9, "Very High").when(c >= 0.7, "High").when(c >= 0.5, "Medium").when(c >= 0.3, "Low").otherwise("Very Low")
    return e.select("event_id", r6(c).alias("conf"), level.alias("level"))


@query("""
WITH v AS (SELECT vec_id, list_transform(range(0, 10), lambda i: list_sum(list_slice(embedding, i * (len(embedding) // 10) + 1, (i + 1) * (len(embedding) // 10)))::DOUBLE) AS s FROM embeddings)
SELECT vec_id, round(list_avg(s), 3) AS mean, round(sqrt(list_var_pop(s)), 3) AS sd FROM v""")
def slice_uncertainty(spark: SparkSession, sf: str) -> DataFrame:
    """Ten contiguous slices of an ensemble's outputs; the rest of the outputs is left out."""
    width = F.floor(F.size("embedding") / 10).cast("int")
    total = lambda i: F.aggregate(F.slice("embedding", i * width + 1, width), F.lit(0.0), lambda a, x: a + x)
    s = F.transform(F.sequence(F.lit(0), F.lit(9)), total)
    mean = F.aggregate("s", F.lit(0.0), lambda a, x: a + x) / 10
    v = table(spark, sf, "embeddings").select("vec_id", s.alias("s")).withColumn("mean", mean)
    var = F.aggregate("s", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / 10
    return v.select("vec_id", F.round("mean", 3).alias("mean"), F.round(F.sqrt(var), 3).alias("sd"))


@query("""
SELECT CASE WHEN l_quantity <= 5 THEN '[0, 5]' WHEN l_quantity <= 10 THEN '(5, 10]' WHEN l_quantity <= 20 THEN '(10, 20]' ELSE '(20, inf)' END AS bucket, count(*) AS n FROM lineitem GROUP BY ALL""")
def risk_buckets(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    bucket = F.when(q <= 5, "[0, 5]").when(q <= 10, "(5, 10]").when(q <= 20, "(10, 20]").otherwise("(20, inf)")
    return table(spark, sf, "lineitem").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem), d AS (SELECT y, p, p - y AS e FROM e)
SELECT round(avg(e * e), 2) AS mse, round(avg(abs(e)), 4) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, round(avg(CASE WHEN e < 0 THEN 2 * e * e ELSE e * e END), 2) AS asymmetric,
       round(median(e), 4) AS med, round(avg((e < 0)::INTEGER), 6) AS under, round(avg(pow(ln(1 + p) - ln(1 + y), 2)), 6) AS msle FROM d""")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p")).withColumn("e", F.col("p") - F.col("y"))
    e = F.col("e")
    middle = ranks.median_of(d, [], "e", "middle").select(F.round("middle", 4).alias("med"))
    one = d.agg(F.round(F.avg(e * e), 2).alias("mse"), F.round(F.avg(F.abs(e)), 4).alias("mae"), r6(1 - F.sum(e * e) / (F.var_pop("y") * F.count("*"))).alias("r2"),
                 F.round(F.avg(F.when(e < 0, 2 * e * e).otherwise(e * e)), 2).alias("asymmetric"), r6(F.avg((e < 0).cast("int"))).alias("under"),
                r6(F.avg(F.pow(F.log(1 + F.col("p")) - F.log(1 + F.col("y")), 2))).alias("msle"))
    return one.crossJoin(F.broadcast(middle))  # one row each


@query("""
WITH c AS (SELECT count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp, count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 0 AND toxic = 1) AS tn FROM labels)
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    q, p = F.col("quality") == 1, F.col("toxic") == 0
    c = table(spark, sf, "labels").agg(F.count_if(q & p).alias("tp"), F.count_if(~q & p).alias("fp"), F.count_if(q & ~p).alias("fn"), F.count_if(~q & ~p).alias("tn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("tp", "fp", "fn", "tn", r6(F.try_divide(tp, tp + fp)).alias("precision"), r6(F.try_divide(tp, tp + fn)).alias("recall"), r6(F.try_divide(2 * tp, 2 * tp + fp + fn)).alias("f1"))


@query("""
WITH g AS (SELECT unnest(range(0, 11)) AS step), m AS (SELECT step, avg((l_quantity * 1500 + step / 10.0::DOUBLE * 20000 >= l_extendedprice)::INTEGER) AS tpr,
  avg(abs(l_quantity * 1500 + step / 10.0::DOUBLE * 20000 - l_extendedprice)) AS mae FROM lineitem, g GROUP BY step),
n AS (SELECT *, 0.7::DOUBLE * (tpr - min(tpr) OVER ()) / nullif(max(tpr) OVER () - min(tpr) OVER (), 0) - 0.3::DOUBLE * (mae - min(mae) OVER ()) / nullif(max(mae) OVER () - min(mae) OVER (), 0) AS score FROM m)
SELECT step::INTEGER AS step, round(tpr, 6) AS tpr, round(mae, 3) AS mae, (row_number() OVER (ORDER BY score DESC, step) = 1) AS best FROM n""")
def safety_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """All factors in one pass: two averages a factor, no row is multiplied."""
    pred, y = F.col("l_quantity") * 1500, F.col("l_extendedprice")
    factor = lambda i: pred + F.lit(i / 10.0) * 20000
    sums = [F.struct(F.lit(i).alias("step"), F.avg((factor(i) >= y).cast("int")).alias("tpr"), F.avg(F.abs(factor(i) - y)).alias("mae")).alias(f"s{i}") for i in range(11)]
    m = table(spark, sf, "lineitem").agg(*sums).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(11)])))
    every = Window.partitionBy()  # eleven rows
    norm = lambda c: F.try_divide(F.col(c) - F.min(c).over(every), F.max(c).over(every) - F.min(c).over(every))
    n = m.withColumn("score", 0.7 * norm("tpr") - 0.3 * norm("mae"))
    return n.select("step", r6(F.col("tpr")).alias("tpr"), F.round("mae", 3).alias("mae"), (F.row_number().over(Window.orderBy(F.desc("score"), "step")) == 1).alias("best"))


@query("""
WITH q AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s, quantile_cont(o_totalprice, list_transform(range(1, 100), lambda i: i / 100.0::DOUBLE)) AS v FROM orders)
SELECT unnest(range(1, 100))::INTEGER AS pct, round(unnest(list_transform(v, lambda x: (x - m) / s)), 6) AS multiplier FROM q""")
def percentile_multipliers(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("o_totalprice")
    o = table(spark, sf, "orders").select("o_totalprice")
    q = ranks.quantiles(o, [], "o_totalprice", [i / 100 for i in range(1, 100)], also={"m": F.avg(x), "s": F.stddev_pop(x)})
    return q.select(F.posexplode("q").alias("i", "x"), "m", "s").select((F.col("i") + 1).alias("pct"), r6(F.when(F.col("s") > 0, (F.col("x") - F.col("m")) / F.col("s")).otherwise(0.0)).alias("multiplier"))


@query("""
WITH n AS (SELECT p_brand AS a, p_size % 5 AS b, count(*)::DOUBLE AS n FROM part GROUP BY ALL), r AS (SELECT a, sum(n) AS ra FROM n GROUP BY a), c AS (SELECT b, sum(n) AS cb FROM n GROUP BY b), t AS (SELECT sum(n) AS t FROM n)
SELECT round(sqrt((sum(n * n / (ra * cb)) - 1) / least((SELECT count(*) FROM r) - 1, (SELECT count(*) FROM c) - 1)), 6) AS v FROM n JOIN r USING (a) JOIN c USING (b), t""")
def cramers_v(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "part").groupBy(F.col("p_brand").alias("a"), (F.col("p_size") % 5).alias("b")).agg(F.count("*").cast("double").alias("n"))
    w = n.withColumn("ra", F.sum("n").over(Window.partitionBy("a"))).withColumn("cb", F.sum("n").over(Window.partitionBy("b")))
    g = w.agg(F.sum(F.col("n") * F.col("n") / (F.col("ra") * F.col("cb"))).alias("s"), F.countDistinct("a").alias("na"), F.countDistinct("b").alias("nb"))
    return g.select(r6(F.sqrt((F.col("s") - 1) / F.least(F.col("na") - 1, F.col("nb") - 1))).alias("v"))


@query("""
WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY ALL), a AS (SELECT avg(o_totalprice) AS m, var_pop(o_totalprice) * count(*) AS sst FROM orders)
SELECT round(sum(g.n * pow(g.m - a.m, 2)) / any_value(a.sst), 8) AS eta2 FROM g, a""")
def corr_ratio(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("o_totalprice")
    g = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss"))  # one pass; the rest is over a few groups
    t = g.agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("ss").alias("ss"))
    mean_part = F.col("s") * F.col("s") / F.col("n")
    return t.select(F.round((F.col("b") - mean_part) / (F.col("ss") - mean_part), 8).alias("eta2"))


@query("""SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price, round(corr(l_quantity, l_discount), 6) AS quantity_discount, round(corr(l_extendedprice, l_tax), 6) AS price_tax FROM lineitem""")
def pearson(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(r6(F.corr("l_quantity", "l_extendedprice")).alias("quantity_price"), r6(F.corr("l_quantity", "l_discount")).alias("quantity_discount"), r6(F.corr("l_extendedprice", "l_tax")).alias("price_tax"))


@query("""
WITH a AS (SELECT avg(o_totalprice) AS m, count(*)::DOUBLE AS n FROM orders), c AS (SELECT avg(pow(o_totalprice - m, 2)) AS m2, avg(pow(o_totalprice - m, 3)) AS m3, avg(pow(o_totalprice - m, 4)) AS m4, any_value(n) AS n FROM orders, a)
SELECT round(m3 / pow(m2, 1.5::DOUBLE), 5) AS skew, round(m4 / (m2 * m2) - 3, 5) AS kurt, round(n / 6 * (pow(m3 / pow(m2, 1.5::DOUBLE), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4), 2) AS jb FROM c""")
def skew_kurt_jb(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "orders").agg(F.skewness("o_totalprice").alias("s"), F.kurtosis("o_totalprice").alias("k"), F.count("*").alias("n"))
    return m.select(F.round("s", 5).alias("skew"), F.round("k", 5).alias("kurt"), F.round(F.col("n") / 6 * (F.pow("s", F.lit(2)) + F.pow("k", F.lit(2)) / 4), 2).alias("jb"))


@query("""
WITH r AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS i FROM orders)
SELECT o_orderpriority, round(regr_r2(o_totalprice, i), 5) AS r2 FROM r GROUP BY ALL""")
def rank_fit_r2(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks of equal values sum up, so values are ranked with their counts, in ranges, and no group is sorted in one task."""
    r = ranks.counted_ranks(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice")
    n, x, before = F.col("n").cast("double"), F.col("o_totalprice"), F.col("before").cast("double")
    of_ranks = n * before + n * (n + 1) / 2
    of_squares = n * before * before + before * n * (n + 1) + n * (n + 1) * (2 * n + 1) / 6
    g = r.groupBy("o_orderpriority").agg(F.sum(n).alias("n"), F.sum(of_ranks).alias("i"), F.sum(of_squares).alias("ii"), F.sum(n * x).alias("x"), F.sum(n * x * x).alias("xx"), F.sum(of_ranks * x).alias("ix"))
    c = F.col
    both = c("n") * c("ix") - c("i") * c("x")
    return g.select("o_orderpriority", F.round(both * both / ((c("n") * c("ii") - c("i") * c("i")) * (c("n") * c("xx") - c("x") * c("x"))), 5).alias("r2"))


@query("""
WITH d AS (SELECT l_orderkey, list_distinct(list(isodow(l_shipdate))) AS days, count(*) AS vacancy, any_value(year(o_orderdate)) AS y, any_value(o_totalprice) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT l_orderkey, vacancy, list_contains(days, 1)::INTEGER AS has_mon, list_contains(days, 3)::INTEGER AS has_wed, list_contains(days, 7)::INTEGER AS has_sun, (price > 0) AS bids, CASE WHEN y = 1998 THEN 'test' ELSE 'train' END AS split FROM d""")
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("price"))
    day = lambda n: F.max((F.dayofweek("l_shipdate") == n).cast("int"))
    l = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("vacancy"), day(2).alias("has_mon"), day(4).alias("has_wed"), day(1).alias("has_sun"))
    return l.join(o, "l_orderkey").select("l_orderkey", "vacancy", "has_mon", "has_wed", "has_sun", (F.col("price") > 0).alias("bids"), F.when(F.col("y") == 1998, "test").otherwise("train").alias("split"))


@query("""
SELECT event_id, CASE WHEN value / 100 >= 0.7 AND event_id % 10 >= 7 THEN 'aggressive' WHEN event_id % 10 < 3 THEN 'skip' WHEN value / 100 >= 0.7 THEN 'moderate' ELSE 'cautious' END AS strategy,
       CASE WHEN event_id % 9 = 0 THEN 'N/A' ELSE 'https://boss/' || printf('%04d', event_id) END AS link FROM events""")
def bid_strategy(spark: SparkSession, sf: str) -> DataFrame:
    sure, prob = F.col("value") / 100 >= 0.7, F.col("event_id") % 10
    strategy = F.when(sure & (prob >= 7), "aggressive").when(prob < 3, "skip").when(sure, "moderate").otherwise("cautious")
    key = F.when(F.col("event_id") % 9 != 0, F.col("event_id"))
    link = F.when(key.isNull(), "N/A").otherwise(F.concat(F.lit("https://boss/"), F.format_string("%04d", key)))
    return table(spark, sf, "events").select("event_id", strategy.alias("strategy"), link.alias("link"))


@query("""
WITH m AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders), g AS (SELECT o_orderpriority AS k, avg(o_totalprice) AS mean FROM orders GROUP BY ALL), c AS (SELECT k, (row_number() OVER (ORDER BY k) - 1)::INTEGER AS code, mean FROM g)
SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS scaled, code, round(mean, 7) AS mean FROM orders JOIN c ON o_orderpriority = k, m""")
def scalers_encoders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    bounds = o.agg(F.min("o_totalprice").alias("a"), F.max("o_totalprice").alias("b"))
    c = o.groupBy(F.col("o_orderpriority").alias("k")).agg(F.avg("o_totalprice").alias("mean")).withColumn("code", F.row_number().over(Window.orderBy("k")) - 1)
    j = o.join(c, F.col("o_orderpriority") == F.col("k")).crossJoin(F.broadcast(bounds))  # one row
    return j.select("o_orderkey", r6(F.try_divide(F.col("o_totalprice") - F.col("a"), F.col("b") - F.col("a"))).alias("scaled"), "code", F.round("mean", 7).alias("mean"))


@query("""
WITH s AS (SELECT l_orderkey, list(l_suppkey) AS x FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CASE WHEN len(list_distinct(x)) = len(x) THEN 'none' WHEN len(list_distinct(x)) = 1 THEN 'single' ELSE 'some' END AS repeats FROM s""")
def list_repeats(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("l_suppkey").alias("n"), F.countDistinct("l_suppkey").alias("d"))
    return s.select("l_orderkey", F.when(F.col("d") == F.col("n"), "none").when(F.col("d") == 1, "single").otherwise("some").alias("repeats"))


@query("""
SELECT l_orderkey, l_linenumber, coalesce(try_cast(CASE WHEN l_linenumber = 3 THEN 'x' ELSE l_partkey::VARCHAR END AS INTEGER), 0) AS v, CASE WHEN l_linenumber = 3 THEN 'NA' ELSE l_partkey::VARCHAR END AS t FROM lineitem""")
def numeric_coercion(spark: SparkSession, sf: str) -> DataFrame:
    t = F.when(F.col("l_linenumber") == 3, "TBA").otherwise(F.col("l_partkey").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(T.whole_number(t), F.lit(0)).alias("v"), F.when(T.is_unset(t), "NA").otherwise(t).alias("t"))
