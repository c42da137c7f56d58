"""Names, codes, pages, dates: resolving text to entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.operators import names as N
from seatloom.operators import tables as op
from seatloom.plans.registry import query
from seatloom.runtime import table


@query("""
WITH c AS (SELECT c_nationkey % 7 AS prefix, c_nationkey AS fac, count(*) AS n, min(c_custkey) AS seen FROM customer GROUP BY ALL),
u AS (SELECT prefix, CASE WHEN count(*) = 1 THEN min(fac) END AS unanimous FROM c GROUP BY ALL)
SELECT prefix, fac AS faculty, n, unanimous FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY n DESC, seen) AS p FROM c) JOIN u USING (prefix) WHERE p = 1""")
def majority_faculty(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").groupBy((F.col("c_nationkey") % 7).alias("prefix"), F.col("c_nationkey").alias("faculty")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("seen"))
    u = c.groupBy("prefix").agg(F.when(F.count("*") == 1, F.min("faculty")).alias("unanimous"))
    return op.first_per_key(c, ["prefix"], [F.desc("n"), F.col("seen")]).join(u, "prefix").select("prefix", "faculty", "n", "unanimous")


# the lists as text, and the walk over them: the longest (or shortest) known run from each place on, unknown single words to the name before
_WALK = """,
a AS (SELECT DISTINCT upper(trim(name)) AS alias FROM s), p AS (SELECT s_suppkey, names, list_filter(list_transform(string_split(names, ','), lambda x: trim(x)), lambda x: x <> '') AS parts FROM lists),
r AS (SELECT s_suppkey, i, j FROM (SELECT s_suppkey, parts, unnest(range(0, len(parts))) AS i FROM p), (SELECT unnest(range(1, 12)) AS j) WHERE j > i AND j <= len(parts) AND upper(array_to_string(parts[i + 1:j], ', ')) IN (SELECT alias FROM a)),
e AS (SELECT s_suppkey, i, {pick}(j) AS j FROM r GROUP BY ALL),
w AS (SELECT s_suppkey, parts, 0::BIGINT AS i, []::VARCHAR[] AS out FROM p UNION ALL
  SELECT w.s_suppkey, parts, CASE WHEN e.j IS NOT NULL THEN e.j ELSE w.i + 1 END, CASE WHEN e.j IS NOT NULL THEN list_append(out, array_to_string(parts[w.i + 1:e.j], ', '))
    WHEN len(out) > 0 AND NOT contains(parts[w.i + 1], ' ') THEN list_append(out[1:len(out) - 1], out[len(out)] || ', ' || parts[w.i + 1]) ELSE list_append(out, parts[w.i + 1]) END
  FROM w LEFT JOIN e ON e.s_suppkey = w.s_suppkey AND e.i = w.i WHERE w.i < len(parts))
SELECT s_suppkey, CASE WHEN upper(trim(names)) IN (SELECT alias FROM a) THEN [trim(names)] ELSE out END AS people FROM w JOIN p USING (s_suppkey) WHERE w.i >= len(w.parts)"""
_NAMES = "WITH RECURSIVE s AS (SELECT s_suppkey, replace(s_name, '#', ', ') AS name FROM supplier)"


@query(_NAMES + ", lists AS (SELECT s_suppkey, name || ', Jr, Unknown Person, ' || lead(name, 1, 'Nobody') OVER (PARTITION BY s_suppkey % 10 ORDER BY s_suppkey) AS names FROM s)" + _WALK.replace("{pick}", "max"))
def name_greedy_split(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", F.replace("s_name", F.lit("#"), F.lit(", ")).alias("name"))
    lists = s.select("s_suppkey", F.concat("name", F.lit(", Jr, Unknown Person, "), F.lead("name", 1, "Nobody").over(Window.partitionBy(F.col("s_suppkey") % 10).orderBy("s_suppkey"))).alias("names"))
    return N.split_names(lists, "s_suppkey", "names", s, "name")


@query(_NAMES + ", lists AS (SELECT s_suppkey, name AS names FROM s)" + _WALK.replace("{pick}", "min"))
def shortest_split(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", F.replace("s_name", F.lit("#"), F.lit(", ")).alias("name"))
    return N.split_names(s, "s_suppkey", "name", s, "name", shortest=True)


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE s_suppkey END AS person,
       CASE s_suppkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 6 END AS strategy FROM supplier""")
def name_resolution(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("no"))
    known = s.select(F.col("s_suppkey").alias("person"), F.when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("SUPPLIER"), "no")).otherwise(F.concat(F.lit("Supplier "), "no")).alias("alias"))
    k = F.col("s_suppkey") % 4
    asked = s.select("s_suppkey", F.when(k == 0, F.concat(F.lit(" supplier "), "no")).when(k == 1, F.concat(F.lit("Supplier, "), "no")).when(k == 2, F.concat("no", F.lit(" Supplier"))).otherwise("TBA").alias("name"))
    return N.resolve(asked, "s_suppkey", "name", known, "person", "alias")


@query("""
SELECT event_id, list_concat([json_extract_string(props, '$.k')], []) AS ks, 1 AS n, lower(event_type) AS slug FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def alias_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('["'), k, F.lit('"]'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"'), k, F.lit('"}'))).otherwise(k)
    e = table(spark, sf, "events").filter(k.isNotNull()).withColumn("ks", T.aliases(text))
    return e.select("event_id", "ks", F.size("ks").alias("n"), T.slug(F.concat(F.lit("  "), F.upper("event_type"), F.lit("! "))).alias("slug"))


@query(r"""
SELECT page_id, regexp_extract(html, '<html lang="(\w+)"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<li>')) AS items,
       regexp_extract(regexp_extract_all(html, '<li>(.*?)</li>')[1], '>([^<>]+)</a>', 1) AS first_item FROM pages""")
def html_extract(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("html")
    items = F.regexp_extract_all(h, F.lit("<li>(.*?)</li>"), 1)
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract(h, r'<html lang="(\w+)"', 1).alias("lang"), F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_count(h, F.lit("<li>")).cast("long").alias("items"), F.regexp_extract(F.get(items, F.lit(0)), ">([^<>]+)</a>", 1).alias("first_item"),
    )


@query(r"""
SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host, nullif(regexp_extract(url, '/(\d+)', 1), '')::INTEGER AS no,
       nullif(regexp_extract(url, '/(en|fr|de|es)/', 1), '') AS code, coalesce(url LIKE '%.html%', false) AS is_html FROM pages""")
def text_codes(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", F.regexp_extract(u, "://([^/]+)", 1).alias("host"), T.found(u, r"/(\d+)").try_cast("int").alias("no"), T.found(u, "/(en|fr|de|es)/").alias("code"), F.coalesce(u.contains(".html"), F.lit(False)).alias("is_html"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000 +0800' AS shown, day(o_orderdate)::INTEGER AS d, month(o_orderdate)::INTEGER AS m, NULL::VARCHAR AS bad FROM orders""")
def date_text(spark: SparkSession, sf: str) -> DataFrame:
    shown = T.date_text(F.date_format("o_orderdate", "d-MMM-yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", shown.alias("shown"), F.dayofmonth(F.try_to_timestamp(F.substring(shown, 1, 10))).alias("d"), F.month(F.try_to_timestamp(F.substring(shown, 1, 10))).alias("m"), T.date_text(F.lit("31-Foo-2020")).alias("bad"))


@query("""
SELECT o_orderkey, CASE WHEN (month(o_orderdate), day(o_orderdate)) >= (7, 1) THEN 'T1' WHEN (month(o_orderdate), day(o_orderdate)) >= (6, 29) THEN 'T3B' WHEN (month(o_orderdate), day(o_orderdate)) >= (5, 11) THEN 'T3A' ELSE 'T2' END AS term,
       (year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 0 ELSE 1 END)::INTEGER AS start_year FROM orders""")
def year_sequence(spark: SparkSession, sf: str) -> DataFrame:
    md = F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")
    term = F.when(md >= 701, "T1").when(md >= 629, "T3B").when(md >= 511, "T3A").otherwise("T2")
    return table(spark, sf, "orders").select("o_orderkey", term.alias("term"), (F.year("o_orderdate") - F.when(F.month("o_orderdate") >= 7, 0).otherwise(1)).alias("start_year"))


@query("""
SELECT event_id, value > 50 AS high, CASE WHEN event_id % 5 <> 0 AND event_type <> 'click' THEN 'kept' ELSE 'dropped' END AS fate,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind FROM events WHERE event_id % 7 <> 0""")
def null_key_filters(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "value", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("kind"), F.nullif(F.col("event_id") % 7, F.lit(0)).alias("key"))
    kept = F.coalesce(F.col("kind") != "click", F.lit(False))
    return e.dropna(subset=["key"]).select("event_id", (F.col("value") > 50).alias("high"), F.when(kept, "kept").otherwise("dropped").alias("fate"), "kind")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 10 ELSE l_quantity END AS floor10, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS code,
       CASE WHEN l_quantity = 45 THEN 4.5 ELSE l_quantity END::DOUBLE AS patched, printf('%04d', l_partkey) AS padded FROM lineitem""")
def derived_counts(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    code = F.try_element_at(F.create_map(F.lit("A"), F.lit(1), F.lit("N"), F.lit(2)), F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.greatest(q, F.lit(10.0)).alias("floor10"), code.alias("code"), F.when(q == 45, 4.5).otherwise(q).alias("patched"), F.format_string("%04d", "l_partkey").alias("padded"))


@query("""
WITH f AS (SELECT row_number() OVER (ORDER BY r_regionkey) AS id, r_regionkey FROM region)
SELECT n_nationkey, upper(left(r_name, 3)) AS acronym, coalesce(f.id, 0)::INTEGER AS faculty FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN f ON f.r_regionkey = n_regionkey AND n_nationkey % 6 <> 0""")
def dept_to_faculty(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region")
    f = op.surrogate_ids(r.select(F.col("r_regionkey").alias("f_key")), [F.col("f_key")], 0, "id")
    n = table(spark, sf, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(f, (F.col("f_key") == F.col("n_regionkey")) & (F.col("n_nationkey") % 6 != 0), "left")
    return n.select("n_nationkey", F.upper(F.substring("r_name", 1, 3)).alias("acronym"), F.coalesce("id", F.lit(0)).alias("faculty"))


@query("""
SELECT c_custkey, list_sort(list_distinct([upper(c_name), upper(c_mktsegment)])) AS aliases, (c_custkey % 2 = 0) AS updated FROM customer""")
def alias_append(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.array(F.upper("c_name")).alias("old"), F.array(F.upper("c_name"), F.upper("c_mktsegment")).alias("asked"))
    old = F.when(F.col("c_custkey") % 2 == 0, F.col("old")).otherwise(F.col("asked"))
    return c.select("c_custkey", F.array_sort(F.array_union(old, "asked")).alias("aliases"), (F.size(F.array_except("asked", old)) > 0).alias("updated"))


@query("""
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'error' ELSE 'ok' END AS outcome, CASE page_id % 3 WHEN 0 THEN 'Graded' WHEN 1 THEN 'Pass/Fail' ELSE 'NA' END AS grading FROM pages""")
def grading_and_window(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id")
    raw = F.when(k % 3 == 0, " graded ").when(k % 3 == 1, "PASS/fail basis").otherwise("-")
    p = table(spark, sf, "pages").select("page_id", F.when(k % 5 != 0, "head").alias("header"), F.lower(F.trim(raw)).alias("raw"))
    grading = F.when(F.col("raw").contains("pass"), "Pass/Fail").when(F.col("raw").contains("graded"), "Graded").otherwise("NA")
    return p.select("page_id", F.when(F.col("header").isNull(), "error").otherwise("ok").alias("outcome"), grading.alias("grading"))
