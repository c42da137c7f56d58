"""Joins, set operations, change detection and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.operators import ranks
from seatloom.operators import tables as op
from seatloom.operators.reconcile import reconcile
from seatloom.plans.registry import query
from seatloom.runtime import table


@query("""
WITH p AS (SELECT l_partkey, l_suppkey, year(o_orderdate) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_partkey, l_suppkey FROM p WHERE y = 1998 EXCEPT SELECT l_partkey, l_suppkey FROM p WHERE y < 1998""")
def new_entities(spark: SparkSession, sf: str) -> DataFrame:
    # one pass: a pair is new if its first year is the last one
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y")).filter("y <= 1998")
    p = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return p.groupBy("l_partkey", "l_suppkey").agg(F.min("y").alias("first")).filter("first = 1998").select("l_partkey", "l_suppkey")


@query("""
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linestatus = 'O')
SELECT (SELECT count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)) AS both_n, (SELECT count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)) AS a_only, (SELECT count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)) AS b_only""")
def common_keys(spark: SparkSession, sf: str) -> DataFrame:
    # both sets in one pass: a flag for each, by key
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("a"), F.max((F.col("l_linestatus") == "O").cast("int")).alias("b"))
    return g.agg(F.count_if(F.col("a") + F.col("b") == 2).alias("both_n"), F.count_if(F.col("a") > F.col("b")).alias("a_only"), F.count_if(F.col("b") > F.col("a")).alias("b_only"))


@query("""SELECT c_nationkey AS nation, round(c_acctbal, 0) AS bal FROM customer UNION SELECT s_nationkey, round(s_acctbal, 0) FROM supplier""")
def union_dedup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.round("c_acctbal", 0).alias("bal"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.round("s_acctbal", 0).alias("bal"))
    return c.unionByName(s).dropDuplicates()


@query("""
SELECT o_orderkey, coalesce(l_returnflag, o_orderstatus) AS flag, l_linenumber FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 30) ON o_orderkey = l_orderkey""")
def enrich_left_join(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").filter("l_quantity > 30")
    return table(spark, sf, "orders").join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("l_returnflag", "o_orderstatus").alias("flag"), "l_linenumber")


@query("""
SELECT a.l_orderkey, a.l_linenumber, b.l_linenumber AS other FROM lineitem a JOIN lineitem b
ON a.l_partkey || '_' || a.l_suppkey || '_' || year(a.l_shipdate) = b.l_partkey || '_' || b.l_suppkey || '_' || year(b.l_shipdate) AND a.l_orderkey < b.l_orderkey""")
def multi_key_inner(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of a key are the answer, so a hot key costs what it yields."""
    key = ["l_partkey", "l_suppkey", "year"]
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"))
    b = a.select(F.col("l_orderkey").alias("o2"), F.col("l_linenumber").alias("other"), *key)
    return a.join(b, key).filter("l_orderkey < o2").select("l_orderkey", "l_linenumber", "other")


@query("""
WITH c AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT o_orderkey, p_partkey, c.l_suppkey AS class_id FROM orders JOIN part ON p_partkey = o_orderkey % 200 + 1 JOIN c ON c.l_partkey = p_partkey WHERE o_orderstatus = 'F'""")
def fanout_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_orderkey") % 200 + 1).alias("p_partkey"))
    return o.join(table(spark, sf, "part").select("p_partkey"), "p_partkey").join(c, F.col("p_partkey") == F.col("l_partkey")).select("o_orderkey", "p_partkey", F.col("l_suppkey").alias("class_id"))


@query("""
WITH s AS (SELECT DISTINCT date_trunc('day', ts) AS t FROM events), n AS (SELECT t, strftime(t, '%Y-%m-%d') AS name, lag(strftime(t, '%Y-%m-%d')) OVER (ORDER BY t) AS before FROM s)
SELECT event_id, (SELECT min(name) FROM n WHERE n.t > e.ts) AS cur, (SELECT max(name) FROM n WHERE n.t <= e.ts) AS prev FROM events e""")
def asof_current_previous(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    schedule = e.select(F.date_trunc("day", "ts").alias("t")).distinct().withColumn("name", F.date_format("t", "yyyy-MM-dd"))
    return op.as_of(e.select("event_id", "ts"), "ts", schedule, "t", "name").select("event_id", F.col("current").alias("cur"), F.col("previous").alias("prev"))


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey % 2 = 0 AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey
  AND coalesce(nullif(b.l_returnflag, 'N'), '') = coalesce(nullif(a.l_returnflag, 'N'), '') AND b.l_linestatus = a.l_linestatus AND b.l_linenumber = a.l_linenumber)""")
def anti_timing(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_partkey", "l_suppkey", "flag", "l_linestatus", "l_linenumber"]
    a = table(spark, sf, "lineitem").withColumn("flag", F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("")))
    return a.join(a.filter("l_orderkey % 2 = 0").select(*keys), keys, "left_anti").select("l_orderkey", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def semi_active(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").join(o, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("""
WITH v AS (SELECT 'part' AS kind, l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7)
  UNION ALL SELECT 'supplier', l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3))
SELECT kind, count(*) AS violations, count(DISTINCT id) AS ids, list_slice(list_sort(list_distinct(list(id))), 1, 3)::VARCHAR AS some FROM v GROUP BY kind""")
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem")
    p = l.join(table(spark, sf, "part").filter("p_size <> 7"), F.col("l_partkey") == F.col("p_partkey"), "left_anti").select(F.lit("part").alias("kind"), F.col("l_partkey").alias("id"))
    s = l.join(table(spark, sf, "supplier").filter("s_nationkey <> 3"), F.col("l_suppkey") == F.col("s_suppkey"), "left_anti").select(F.lit("supplier").alias("kind"), F.col("l_suppkey").alias("id"))
    by_id = p.unionByName(s).groupBy("kind", "id").agg(F.count("*").alias("n"))  # distinct ids are summed before the kinds meet
    counts = by_id.groupBy("kind").agg(F.sum("n").alias("violations"), F.count("*").alias("ids"))
    # three ids a kind: Spark cuts to them in each task
    few = op.first_per_key(by_id.select("kind", "id"), ["kind"], [F.col("id")], 3).groupBy(F.col("kind").alias("f_kind")).agg(F.array_sort(F.collect_list("id")).alias("top"))
    shown = F.concat(F.lit("["), F.array_join(F.transform("top", lambda x: x.cast("string")), ", "), F.lit("]"))
    return counts.join(few, F.col("kind") == F.col("f_kind")).select("kind", "violations", "ids", shown.alias("some"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'Yes' ELSE 'No' END AS has_order,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R') THEN 'Yes' ELSE 'No' END AS has_return FROM customer""")
def coverage_matrix(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    r = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    has = o.select("c_custkey").distinct().withColumn("h", F.lit(True))
    back = o.join(r, "o_orderkey", "left_semi").select("c_custkey").distinct().withColumn("b", F.lit(True))
    yes = lambda c: F.when(F.col(c), "Yes").otherwise("No")
    return table(spark, sf, "customer").select("c_custkey").join(has, "c_custkey", "left").join(back, "c_custkey", "left").select("c_custkey", yes("h").alias("has_order"), yes("b").alias("has_return"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment FROM customer UNION ALL SELECT c_custkey + 1000000, 'NEW' FROM customer WHERE c_custkey % 50 = 0""")
def overlay_latest(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    changed = c.filter("c_custkey % 5 = 0").withColumn("segment", F.lit("NEW"))
    added = c.filter("c_custkey % 50 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.lit("NEW").alias("segment"))
    return op.overlay(c, changed.unionByName(added), ["c_custkey"], [F.col("segment")])


@query("""
WITH g AS (SELECT unnest([50, 60, 70, 80, 90, 95, 99]) AS pct), a AS (SELECT o_orderkey, (o_orderkey * 7 % 100)::BIGINT AS target FROM orders)
SELECT o_orderkey, target, arg_min(pct, (abs(pct - target), pct))::INTEGER AS nearest FROM a, g GROUP BY ALL""")
def nearest_multiplier(spark: SparkSession, sf: str) -> DataFrame:
    levels = F.array(*[F.lit(x) for x in (50, 60, 70, 80, 90, 95, 99)])
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") * 7 % 100).alias("target"))
    nearest = F.array_min(F.transform(levels, lambda p: F.struct(F.abs(p - F.col("target")).alias("d"), p.alias("p"))))["p"]
    return o.select("o_orderkey", "target", nearest.alias("nearest"))


@query("""
WITH m AS (SELECT *, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS new_price, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS new_status FROM orders)
SELECT o_orderkey, (new_price IS DISTINCT FROM o_totalprice) AS price_changed, (new_status IS NOT NULL AND new_status <> o_orderstatus) AS status_changed,
       coalesce(new_status, o_orderstatus) AS kept_status FROM m WHERE new_price IS DISTINCT FROM o_totalprice OR o_orderkey % 11 = 0""")
def class_diff(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = old.select("o_orderkey", (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)).alias("new_price"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("new_status"))
    j = new.join(old, "o_orderkey")
    price = ~F.col("new_price").eqNullSafe(F.col("o_totalprice"))
    status = op.differs(F.col("new_status"), F.col("o_orderstatus"), ignore_missing=True)
    return j.filter(price | (F.col("o_orderkey") % 11 == 0)).select("o_orderkey", price.alias("price_changed"), status.alias("status_changed"), F.coalesce("new_status", "o_orderstatus").alias("kept_status"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'update' WHEN p_partkey % 10 = 3 THEN 'create' ELSE 'same' END AS action,
       CASE WHEN p_partkey % 10 = 3 AND p_partkey % 4 = 0 THEN 'Unknown Course' WHEN p_partkey % 9 = 0 AND p_partkey % 10 <> 3 THEN p_name || '!' ELSE p_name END AS name
FROM (SELECT * FROM part WHERE NOT (p_partkey % 9 = 0 AND p_partkey % 10 = 3))""")
def course_diff(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    every = table(spark, sf, "part").select("p_partkey", "p_name").filter(~((k % 9 == 0) & (k % 10 == 3)))
    old = every.filter(k % 10 != 3).select("p_partkey", F.col("p_name").alias("old_name"))
    new = every.select("p_partkey", F.when(k % 9 == 0, F.concat("p_name", F.lit("!  "))).when((k % 10 == 3) & (k % 4 == 0), F.lit(None)).otherwise(F.col("p_name")).alias("new_name"))
    j = new.join(old.withColumn("known", F.lit(True)), "p_partkey", "left")
    action = F.when(F.col("known").isNull(), "create").when(op.differs(F.col("new_name"), F.col("old_name")), "update").otherwise("same")
    return j.select("p_partkey", action.alias("action"), F.coalesce(F.trim("new_name"), "old_name", F.lit("Unknown Course")).alias("name"))


@query("""
WITH w AS (SELECT DISTINCT year(o_orderdate)::BIGINT AS year, o_orderpriority FROM orders)
SELECT year, o_orderpriority, (100 + row_number() OVER (ORDER BY year, o_orderpriority))::INTEGER AS id FROM w""")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    w = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), "o_orderpriority").distinct()
    return op.surrogate_ids(w, [F.col("year"), F.col("o_orderpriority")], 100, "id")


@query("""SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS p FROM lineitem) WHERE p = 1""")
def first_row_dedup(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return op.first_per_key(l, ["l_partkey"], [F.col("l_orderkey"), F.col("l_linenumber")])


@query("""SELECT o_orderstatus, arg_max(o_orderkey, (year(o_orderdate), o_orderpriority, o_orderkey)) AS latest FROM orders GROUP BY ALL""")
def latest_folder(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.max_by("o_orderkey", F.struct(F.year("o_orderdate"), "o_orderpriority", "o_orderkey")).alias("latest"))


@query("""
WITH f AS (SELECT user_id, event_id, ts, (value > 50)::INTEGER AS f FROM events),
i AS (SELECT *, sum(1 - f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM f)
SELECT event_id, sum(f) OVER (PARTITION BY user_id, island ORDER BY ts, event_id)::BIGINT AS run FROM i""")
def consecutive_runs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return op.runs(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("value") > 50, "run").select("event_id", "run")


@query("""
WITH c AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT l_orderkey, l_linenumber, n, dense_rank() OVER (ORDER BY l_partkey, l_suppkey)::INTEGER AS grp FROM lineitem JOIN c USING (l_partkey, l_suppkey)""")
def dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    groups = l.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n")).filter("n > 1")
    numbered = ranks.dense_ids(groups, "l_partkey", ["l_suppkey"], "grp")
    return l.join(numbered, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "n", "grp")


@query("""
SELECT count(*) AS n, count(DISTINCT CASE WHEN p IS NULL THEN o_custkey END) AS no_price, count(DISTINCT CASE WHEN s IS NULL THEN o_custkey END) AS no_status,
       count(DISTINCT CASE WHEN p IS NULL AND s IS NULL THEN o_custkey END) AS neither FROM (SELECT o_custkey, nullif(o_orderkey % 5, 0) AS p, nullif(o_orderstatus, 'P') AS s FROM orders)""")
def completeness_patterns(spark: SparkSession, sf: str) -> DataFrame:
    p, s, c = F.nullif(F.col("o_orderkey") % 5, F.lit(0)).isNull(), F.nullif("o_orderstatus", F.lit("P")).isNull(), F.col("o_custkey")
    return table(spark, sf, "orders").agg(F.count("*").alias("n"), F.countDistinct(F.when(p, c)).alias("no_price"), F.countDistinct(F.when(s, c)).alias("no_status"), F.countDistinct(F.when(p & s, c)).alias("neither"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 13 = 0 THEN 'class_boss_id_not_found' WHEN l_suppkey % 11 = 0 THEN 'class_not_found' END AS reason FROM lineitem)
SELECT reason, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def reject_log(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    p = table(spark, sf, "part").filter("p_partkey % 13 <> 0").select(F.col("p_partkey").alias("l_partkey"))
    s = table(spark, sf, "supplier").filter("s_suppkey % 11 <> 0").select(F.col("s_suppkey").alias("l_suppkey"))
    no_part = l.join(p, "l_partkey", "left_anti").withColumn("reason", F.lit("class_boss_id_not_found"))
    no_class = l.join(p, "l_partkey", "left_semi").join(s, "l_suppkey", "left_anti").withColumn("reason", F.lit("class_not_found"))
    return no_part.unionByName(no_class).groupBy("reason").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"))


@query("""
WITH a AS (SELECT c_custkey % 100 AS k, min(c_name) AS v FROM customer WHERE c_custkey % 3 = 0 GROUP BY ALL), b AS (SELECT c_custkey % 100 AS k, min(c_name) AS v FROM customer GROUP BY ALL)
SELECT s_suppkey, coalesce(a.v, b.v, 'PENDING_' || s_suppkey) AS name, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 ELSE 2 END AS tier FROM supplier LEFT JOIN a ON s_suppkey % 130 = a.k LEFT JOIN b ON s_suppkey % 130 = b.k""")
def tiered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select((F.col("c_custkey") % 100).alias("k"), "c_name", F.when(F.col("c_custkey") % 3 == 0, 0).otherwise(1).alias("tier"))
    every = c.groupBy("k").agg(F.min(F.when(F.col("tier") == 0, F.col("c_name"))).alias("a"), F.min("c_name").alias("b"))
    j = table(spark, sf, "supplier").join(every, F.col("s_suppkey") % 130 == F.col("k"), "left")
    tier = F.when(F.col("a").isNotNull(), 0).when(F.col("b").isNotNull(), 1).otherwise(2)
    return j.select("s_suppkey", F.coalesce("a", "b", F.concat(F.lit("PENDING_"), F.col("s_suppkey").cast("string"))).alias("name"), tier.alias("tier"))


@query("""
WITH a AS (SELECT l_orderkey, count(*) AS n, list_sort(list(l_partkey || ':' || l_quantity)) AS x FROM lineitem GROUP BY ALL),
b AS (SELECT l_orderkey, count(*) AS n, list_sort(list(l_partkey || ':' || (CASE WHEN l_orderkey % 10 = 1 AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END))) AS x FROM lineitem WHERE NOT (l_orderkey % 17 = 0 AND l_linenumber = 1) GROUP BY ALL)
SELECT a.l_orderkey, (b.n IS NULL OR a.n <> b.n) AS count_differs FROM a LEFT JOIN b USING (l_orderkey) WHERE a.x IS DISTINCT FROM b.x""")
def raw_multiset_diff(spark: SparkSession, sf: str) -> DataFrame:
    l, k = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), F.col("l_orderkey")
    changed = l.filter(~((k % 17 == 0) & (F.col("l_linenumber") == 1))).withColumn("l_quantity", F.when((k % 10 == 1) & (F.col("l_linenumber") == 1), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    # groups are told apart by their count and two sums of hashes, so no group is gathered
    hashes = [F.sum(F.xxhash64("l_partkey", "l_quantity", F.lit(i)).cast("decimal(38,0)")) for i in (1, 2)]
    rows = lambda df, n: df.groupBy(F.col("l_orderkey").alias(f"{n}_key")).agg(F.count("*").alias(f"{n}_n"), F.struct(*hashes).alias(f"{n}_h"))
    j = rows(l, "a").join(rows(changed, "b"), F.col("a_key") == F.col("b_key"), "left")
    j = j.filter(F.col("b_n").isNull() | (F.col("a_n") != F.col("b_n")) | ~F.col("a_h").eqNullSafe(F.col("b_h")))
    return j.select(F.col("a_key").alias("l_orderkey"), (F.col("b_n").isNull() | (F.col("a_n") != F.col("b_n"))).alias("count_differs"))


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, try_cast(l_quantity::INTEGER::VARCHAR AS INTEGER) AS v, 0 AS tier FROM lineitem WHERE l_linenumber <= 2
  UNION ALL SELECT o_orderkey, 1, NULL, 1 FROM orders)
SELECT l_orderkey, l_linenumber, v FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY tier, v) AS p FROM c) WHERE p = 1""")
def bid_result_merge(spark: SparkSession, sf: str) -> DataFrame:
    results = table(spark, sf, "lineitem").filter("l_linenumber <= 2").select("l_orderkey", "l_linenumber", T.whole_number(F.col("l_quantity").cast("int").cast("string")).alias("v"), F.lit(0).alias("tier"))
    placeholders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(None).cast("int").alias("v"), F.lit(1).alias("tier"))
    return op.first_per_key(results.unionByName(placeholders), ["l_orderkey", "l_linenumber"], [F.col("tier"), F.col("v").asc_nulls_last()]).drop("tier")


@query("""
WITH RECURSIVE c AS (SELECT l_orderkey AS boss_id, list({'c': l_orderkey || '-' || l_linenumber, 'p': l_suppkey::VARCHAR} ORDER BY l_orderkey || '-' || l_linenumber, l_suppkey::VARCHAR) AS classes FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL),
f AS (SELECT l_orderkey AS boss_id, l_suppkey::VARCHAR AS p, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL),
g AS (SELECT f.boss_id, list(p ORDER BY pos, p) AS asked, any_value(coalesce(classes, [])) AS classes FROM f LEFT JOIN c USING (boss_id) GROUP BY ALL),
w AS (SELECT boss_id, asked, classes, 0 AS i, []::VARCHAR[] AS used, NULL::VARCHAR AS class_id, NULL::VARCHAR AS professor_id, NULL::VARCHAR AS action FROM g UNION ALL
  SELECT boss_id, asked, classes, i + 1, CASE WHEN chosen IS NULL THEN used ELSE list_append(used, chosen) END, chosen, p,
    CASE WHEN chosen IS NULL THEN 'create' WHEN list_filter(classes, lambda x: x.c = chosen)[1].p = p THEN 'keep' ELSE 'update' END
  FROM (SELECT *, CASE WHEN own IS NOT NULL AND NOT list_contains(used, own) THEN own ELSE coalesce(list_filter(free, lambda x: x.p IS NULL)[1].c, free[1].c) END AS chosen
    FROM (SELECT *, asked[i + 1] AS p, list_filter(classes, lambda x: NOT list_contains(used, x.c)) AS free, list_filter(classes, lambda x: x.p = asked[i + 1])[-1].c AS own FROM w WHERE i < len(asked)))),
d AS (SELECT boss_id, unnest(list_filter(classes, lambda x: NOT list_contains(used, x.c))) AS x FROM w WHERE i = len(asked))
SELECT 'AY202526T1' AS term, boss_id, class_id, professor_id, action FROM w WHERE i > 0 UNION ALL SELECT 'AY202526T1', boss_id, x.c, NULL, 'deactivate' FROM d""")
def class_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of even lines hold an order's classes, those of all lines apply for them."""
    l = table(spark, sf, "lineitem").select(F.lit("AY202526T1").alias("term"), F.col("l_orderkey").alias("boss_id"), "l_linenumber", F.col("l_suppkey").cast("string").alias("professor_id"))
    old = l.filter("l_linenumber % 2 = 0").select("term", "boss_id", F.concat_ws("-", F.col("boss_id").cast("string"), F.col("l_linenumber").cast("string")).alias("class_id"), "professor_id")
    return reconcile(old, l.withColumnRenamed("l_linenumber", "position"))
