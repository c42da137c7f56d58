"""Market questions: participation, price levels and their change, extremes, days. Orders stand for auction results:
o_totalprice is the median bid, the order's year and quarter are the term, o_orderpriority is the bidding window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.operators import ranks
from seatloom.operators import tables as op
from seatloom.plans.registry import query
from seatloom.runtime import table


def r6(c: Column) -> Column:
    return F.round(c, 6)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    year = F.year("o_orderdate").cast("long")
    return table(spark, sf, "orders").withColumns({"year": year, "quarter": F.quarter("o_orderdate").cast("long")})


@query("""
SELECT o_orderpriority AS bid_window, count(*) AS offered, count(*) FILTER (o_totalprice > 150000) AS contested,
       round(count(*) FILTER (o_totalprice > 150000) * 100.0::DOUBLE / count(*), 6) AS contested_rate,
       round(100.0::DOUBLE - count(*) FILTER (o_totalprice > 150000) * 100.0::DOUBLE / count(*), 6) AS idle_rate,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 4 ELSE 9999 END AS place,
       round(sum(count(*) FILTER (o_totalprice > 150000)) OVER () / sum(count(*)) OVER (), 6) AS overall_rate
FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED') GROUP BY o_orderpriority""")
def window_participation(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter(~F.col("o_orderpriority").isin("4-NOT SPECIFIED"))
    rate = F.col("contested") * 100.0 / F.col("offered")
    place = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("1-URGENT", 1, "2-HIGH", 2, "3-MEDIUM", 3, "5-LOW", 4)]), "bid_window"), F.lit(9999))
    every = Window.partitionBy()  # over a few windows, already summed
    out = o.groupBy(F.col("o_orderpriority").alias("bid_window")).agg(F.count("*").alias("offered"), F.count_if(F.col("o_totalprice") > 150000).alias("contested"))
    return out.select("*", r6(rate).alias("contested_rate"), r6(100.0 - rate).alias("idle_rate"), place.alias("place"),
                      r6(F.sum("contested").over(every) / F.sum("offered").over(every)).alias("overall_rate")).orderBy("place")


@query("""
WITH s AS (SELECT year(o_orderdate)::BIGINT AS year, quarter(o_orderdate)::BIGINT AS quarter, median(o_totalprice) AS med, avg(o_totalprice) AS mean,
           stddev_samp(o_totalprice) AS sd, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY ALL),
l AS (SELECT *, lag(med) OVER (ORDER BY year, quarter) AS before FROM s)
SELECT year, quarter, round(med, 6) AS med, round(mean, 7) AS mean, round(sd, 4) AS sd, n,
       round(CASE WHEN before > 0 THEN (med - before) / before * 100 ELSE 0 END, 6) AS change FROM l""")
def semester_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders(spark, sf).filter("o_totalprice > 0")
    more = {"mean": F.avg("o_totalprice"), "sd": F.stddev_samp("o_totalprice")}
    s = ranks.median_of(rows, ["year", "quarter"], "o_totalprice", "med", more)
    before = F.lag("med").over(Window.orderBy("year", "quarter"))  # a row a term
    return s.withColumn("before", before).select("year", "quarter", r6(F.col("med")).alias("med"), F.round("mean", 7).alias("mean"), F.round("sd", 4).alias("sd"), "n",
                                                 r6(T.percent_change(F.col("med"), F.col("before"))).alias("change"))


@query("""
WITH s AS (SELECT year(o_orderdate)::BIGINT AS year, median(o_totalprice) AS med FROM orders GROUP BY ALL),
l AS (SELECT *, lag(med) OVER (ORDER BY year) AS before FROM s),
c AS (SELECT pow(arg_max(med, year) / arg_min(med, year), 1.0::DOUBLE / (count(*) - 1)) - 1 AS cagr FROM s)
SELECT year, round(med, 6) AS med, round(CASE WHEN before > 0 THEN (med - before) / before * 100 ELSE 0 END, 6) AS change, round(cagr, 6) AS cagr FROM l, c""")
def annual_inflation(spark: SparkSession, sf: str) -> DataFrame:
    s = ranks.median_of(orders(spark, sf), ["year"], "o_totalprice", "med").select("year", "med")
    every = Window.partitionBy()  # a row a year
    cagr = F.pow(F.max_by("med", "year").over(every) / F.min_by("med", "year").over(every), F.try_divide(F.lit(1.0), F.count("*").over(every) - 1)) - 1
    l = s.withColumn("before", F.lag("med").over(Window.orderBy("year")))
    return l.select("year", r6(F.col("med")).alias("med"), r6(T.percent_change(F.col("med"), F.col("before"))).alias("change"), r6(cagr).alias("cagr"))


@query("""
WITH s AS (SELECT o_orderpriority, l_linenumber, median(l_extendedprice) AS med, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
l AS (SELECT *, lag(med) OVER (PARTITION BY o_orderpriority ORDER BY l_linenumber) AS before FROM s)
SELECT o_orderpriority, l_linenumber, round(med, 6) AS med, n, round(CASE WHEN before > 0 THEN (med - before) / before * 100 ELSE 0 END, 6) AS change FROM l""")
def round_window_inflation(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    s = ranks.median_of(j, ["o_orderpriority", "l_linenumber"], "l_extendedprice", "med")
    l = s.withColumn("before", F.lag("med").over(Window.partitionBy("o_orderpriority").orderBy("l_linenumber")))
    return l.select("o_orderpriority", "l_linenumber", r6(F.col("med")).alias("med"), "n", r6(T.percent_change(F.col("med"), F.col("before"))).alias("change"))


@query("""
WITH s AS (SELECT o_custkey, year(o_orderdate)::BIGINT AS year, avg(o_totalprice) AS mean FROM orders GROUP BY ALL)
SELECT a.o_custkey, a.year, round(a.mean, 7) AS mean, round((a.mean - b.mean) / b.mean * 100, 4) AS change
FROM s a JOIN s b ON a.o_custkey = b.o_custkey AND a.year = b.year + 1 WHERE b.mean > 0 ORDER BY change DESC, a.o_custkey, a.year LIMIT 5""")
def yoy_top5(spark: SparkSession, sf: str) -> DataFrame:
    s = orders(spark, sf).groupBy("o_custkey", "year").agg(F.avg("o_totalprice").alias("mean"))
    before = s.select("o_custkey", (F.col("year") + 1).alias("year"), F.col("mean").alias("before")).filter("before > 0")
    j = s.join(before, ["o_custkey", "year"]).select("o_custkey", "year", F.round("mean", 7).alias("mean"), F.round((F.col("mean") - F.col("before")) / F.col("before") * 100, 4).alias("change"))
    return j.orderBy(F.desc("change"), "o_custkey", "year").limit(5)


@query("""
SELECT o_custkey, round(median(o_totalprice), 6) AS med, round(max(o_totalprice), 6) AS top, count(*) AS n FROM orders
GROUP BY o_custkey HAVING count(*) >= 3 ORDER BY med DESC, o_custkey LIMIT 5""")
def having_top5(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(r6(F.median("o_totalprice")).alias("med"), r6(F.max("o_totalprice")).alias("top"), F.count("*").alias("n"))
    return g.filter("n >= 3").orderBy(F.desc("med"), "o_custkey").limit(5)


@query("""
SELECT l_returnflag, arg_max(l_orderkey, (l_extendedprice, -l_orderkey)) AS dearest, arg_min(l_orderkey, (l_extendedprice, l_orderkey)) AS cheapest,
       count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL""")
def argmax_rows(spark: SparkSession, sf: str) -> DataFrame:
    price, key = F.col("l_extendedprice"), F.col("l_orderkey")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.max_by("l_orderkey", F.struct(price, -key)).alias("dearest"), F.min_by("l_orderkey", F.struct(price, key)).alias("cheapest"),
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"),
    )


@query("""
WITH m AS (SELECT l_partkey, isodow(l_shipdate) AS day, median(l_extendedprice) AS med FROM lineitem GROUP BY ALL)
SELECT day::INTEGER AS day, round(median(med), 6) AS med, count(*) AS parts FROM m GROUP BY ALL""")
def day_median(spark: SparkSession, sf: str) -> DataFrame:
    day = ((F.dayofweek("l_shipdate") + 5) % 7 + 1).alias("day")
    m = table(spark, sf, "lineitem").groupBy("l_partkey", day).agg(F.median("l_extendedprice").alias("med"))
    return ranks.median_of(m, ["day"], "med", "mid").select("day", r6(F.col("mid")).alias("med"), F.col("n").alias("parts"))


@query("""
WITH d AS (SELECT l_orderkey, count(DISTINCT isodow(l_shipdate)) AS days FROM lineitem GROUP BY ALL)
SELECT days, count(*) AS orders, (days = 1) AS single FROM d GROUP BY ALL""")
def day_histogram(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.countDistinct(F.dayofweek("l_shipdate")).alias("days"))
    return d.groupBy("days").agg(F.count("*").alias("orders")).withColumn("single", F.col("days") == 1)


@query("""
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ', ') AS flags,
       array_to_string(list(l_linestatus ORDER BY l_linenumber, l_partkey, l_linestatus), ',') AS statuses FROM lineitem GROUP BY ALL""")
def list_aggs(spark: SparkSession, sf: str) -> DataFrame:
    in_order = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_linestatus")))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), ", ").alias("flags"), F.array_join(F.transform(in_order, lambda s: s["l_linestatus"]), ",").alias("statuses")
    )


@query("""
WITH c AS (SELECT l_partkey, l_linenumber, count(*) AS n, min(l_orderkey) AS seen FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_linenumber AS line, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, seen, l_linenumber) AS p FROM c) WHERE p = 1""")
def mode_first(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("seen"))
    return op.first_per_key(c, ["l_partkey"], [F.desc("n"), F.col("seen"), F.col("l_linenumber")]).select("l_partkey", F.col("l_linenumber").alias("line"), "n")


@query("""
WITH c AS (SELECT p_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM part GROUP BY ALL)
SELECT * FROM c ORDER BY n DESC, p_type LIMIT 15""")
def value_counts_pct(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return c.withColumn("share", r6(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))).orderBy(F.desc("n"), "p_type").limit(15)


@query("""SELECT floor(l_quantity / 10)::BIGINT AS bin, (floor(l_quantity / 10) * 10 + 5)::DOUBLE AS middle, round(median(l_extendedprice), 6) AS med, count(*) AS n FROM lineitem GROUP BY ALL""")
def bins_median(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.floor(F.col("l_quantity") / 10).alias("bin"), "l_extendedprice")
    g = ranks.median_of(rows, ["bin"], "l_extendedprice", "mid")
    return g.select("bin", (F.col("bin") * 10 + 5).cast("double").alias("middle"), r6(F.col("mid")).alias("med"), "n")


@query("""
WITH b AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS c FROM orders)
SELECT count(*) AS inside, round(sum(o_totalprice), 2) AS total, round(any_value(a - 0.5 * (c - a)), 6) AS low, round(any_value(c + 0.5 * (c - a)), 6) AS high
FROM orders, b WHERE o_totalprice BETWEEN a - 0.5 * (c - a) AND c + 0.5 * (c - a)""")
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_totalprice")
    j = o.crossJoin(F.broadcast(op.quartile_bounds(o, "o_totalprice", 0.5)))  # one row
    return j.filter("o_totalprice BETWEEN low AND high").agg(F.count("*").alias("inside"), F.round(F.sum("o_totalprice"), 2).alias("total"), r6(F.max("low")).alias("low"), r6(F.max("high")).alias("high"))


@query("""
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS earlier_mean FROM orders""")
def expanding_mean(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf, "orders").select("o_orderkey", r6(F.avg("o_totalprice").over(w)).alias("earlier_mean"))


@query("""
SELECT y AS start_year, 'AY' || y || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || 'T' || q AS term, y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || ' Term ' || q AS shown,
       y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || '_T' || q AS dashed, true AS back, n
FROM (SELECT year(o_orderdate)::BIGINT AS y, CASE quarter(o_orderdate) WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3A' ELSE '3B' END AS q, count(*) AS n FROM orders GROUP BY ALL)""")
def term_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    q = F.element_at(F.array(*[F.lit(x) for x in ("1", "2", "3A", "3B")]), F.col("quarter").cast("int"))
    g = orders(spark, sf).groupBy(F.col("year").alias("start_year"), T.term_id(F.col("year"), q).alias("term")).agg(F.count("*").alias("n"))
    shown, dashed = T.term_display(F.col("term")), T.term_dashed(F.col("term"))
    back = (T.term_from_text(shown) == F.col("term")) & (T.term_from_text(dashed) == F.col("term"))
    return g.select("start_year", "term", shown.alias("shown"), dashed.alias("dashed"), back.alias("back"), "n")


@query(r"""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Round 1' || chr(65 + (o_orderkey // 6 % 3)::INT) || ' Window ' || (o_orderkey % 4 + 1)
    WHEN 1 THEN 'Incoming Freshmen Rnd ' || (o_orderkey % 2 + 1) || ' Win ' || (o_orderkey % 4 + 1) WHEN 2 THEN 'Rnd 2A Win ' || (o_orderkey % 5 + 1)
    WHEN 3 THEN 'incoming exchange rnd 1C win 1' WHEN 4 THEN 'Some 2A text' ELSE 'none' END AS x FROM orders),
p AS (SELECT o_orderkey, x, regexp_extract(x, '(?i)Incoming\s+Freshmen\s+Rnd\s+(\w+)\s+Win\s+(\d+)', ['r', 'w']) AS a, regexp_extract(x, '(?i)Incoming\s+Exchange\s+Rnd\s+(\w+)\s+Win\s+(\d+)', ['r', 'w']) AS b,
    regexp_extract(x, '(?i)Round\s+(\d[A-C]?|\d+F?)\s+Window\s+(\d+)', ['r', 'w']) AS c, regexp_extract(x, '(?i)Rnd\s+(\d[A-C]?|\d+F?)\s+Win\s+(\d+)', ['r', 'w']) AS d, regexp_extract(x, '(\d[A-C]?|\d+F?)', 1) AS e FROM t),
q AS (SELECT o_orderkey, CASE WHEN a.r <> '' THEN a.r || 'F' WHEN b.r <> '' THEN b.r WHEN c.r <> '' THEN c.r WHEN d.r <> '' THEN d.r WHEN e <> '' THEN e END AS round,
    CASE WHEN a.r <> '' THEN a.w WHEN b.r <> '' THEN b.w WHEN c.r <> '' THEN c.w WHEN d.r <> '' THEN d.w WHEN e <> '' THEN '1' END::INTEGER AS win FROM p)
SELECT round, win, 'R' || round || 'W' || win AS short, count(*) AS n FROM q GROUP BY ALL""")
def parse_bidding_window(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    made = (
        F.when(k % 6 == 0, F.concat(F.lit("Round 1"), F.char(65 + F.floor(k / 6) % 3), F.lit(" Window "), s(k % 4 + 1)))
        .when(k % 6 == 1, F.concat(F.lit("Incoming Freshmen Rnd "), s(k % 2 + 1), F.lit(" Win "), s(k % 4 + 1)))
        .when(k % 6 == 2, F.concat(F.lit("Rnd 2A Win "), s(k % 5 + 1)))
        .when(k % 6 == 3, "incoming exchange rnd 1C win 1").when(k % 6 == 4, "Some 2A text").otherwise("none")
    )
    w = table(spark, sf, "orders").select(T.parse_window(made, generic=True).alias("w"))
    return w.groupBy(F.col("w.round").alias("round"), F.col("w.window").alias("win"), T.abbreviation(F.col("w")).alias("short")).agg(F.count("*").alias("n"))


@query(r"""
WITH c AS (SELECT p_partkey, upper(replace(p_type, ' ', '-')) || p_size AS code FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(code, '^[A-Z\-]+\d+') THEN regexp_extract(code, '^([A-Z\-]+)(\d+)', 1) ELSE code END AS subject,
       CASE WHEN regexp_matches(code, '^[A-Z\-]+\d+') THEN regexp_extract(code, '^([A-Z\-]+)(\d+)', 2)::INTEGER ELSE 0 END AS number FROM c""")
def course_code_split(spark: SparkSession, sf: str) -> DataFrame:
    code = F.concat(F.replace(F.col("p_type"), F.lit(" "), F.lit("-")), F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", T.split_course(code).alias("c")).select("p_partkey", "c.subject", "c.number")
