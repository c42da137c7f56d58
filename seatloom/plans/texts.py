"""Text functions over the tables' own texts and values: headers, terms, cells, files, names, numbers, windows. The SQL states each rule by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.functions import names as NM
from seatloom.functions import text as T
from seatloom.plans.registry import query
from seatloom.runtime import table


def s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def joined(*parts: str | Column) -> Column:
    """Texts and columns one after another; a plain text is a literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else s(p) for p in parts])


def fields(struct: Column, *names: str) -> list[Column]:
    return [struct[n].alias(n) for n in names]


#: Years and quarters of orders as terms like 1995-96.
TERMS = "year(o_orderdate) AS y, quarter(o_orderdate) AS q, lpad(((year(o_orderdate) + 1) % 100)::VARCHAR, 2, '0') AS yy"


def terms(spark: SparkSession, sf: str) -> DataFrame:
    y = F.year("o_orderdate")
    return table(spark, sf, "orders").withColumns({"y": y, "q": F.quarter("o_orderdate"), "yy": F.lpad(s((y + 1) % 100), 2, "0")})


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type || p_size WHEN 1 THEN p_type || (100 + p_size) WHEN 3 THEN p_type || p_size END AS course_code,
       CASE p_partkey % 4 WHEN 0 THEN 'G' || (p_size % 20) WHEN 1 THEN 'SG' || (p_size % 7) WHEN 3 THEN p_size::VARCHAR END AS section FROM part""")
def header_parse(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    kind = F.col("p_type")
    header = (
        F.when(k == 0, joined(kind, size, "  — G", size % 20, " ", F.col("p_name"))).when(k == 1, joined(kind, " ", size + 100, " - SG", size % 7, " ", F.col("p_name")))
        .when(k == 2, F.col("p_name")).otherwise(joined("<b>", kind, "</b>", size, " ", size, " — ", F.col("p_name")))
    )
    return table(spark, sf, "part").select("p_partkey", *fields(T.parse_header(header), "course_code", "section"))


@query(f"""
WITH o AS (SELECT *, {TERMS} FROM orders),
t AS (SELECT *, CASE q WHEN 1 THEN 'T1' WHEN 2 THEN 'T2' WHEN 3 THEN 'T3' || CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE '' END END AS term FROM o)
SELECT o_orderkey, CASE WHEN q < 4 THEN y END::INTEGER AS year_start, CASE WHEN q < 4 THEN y + 1 END::INTEGER AS year_end, term, 'AY' || y || yy || term AS acad_term_id FROM t""")
def term_inference(spark: SparkSession, sf: str) -> DataFrame:
    q, years = F.col("q"), joined(F.col("y"), "-", F.col("yy"))
    text = F.when(q == 1, joined(years, "  Term 1 ")).when(q == 2, joined(years, " January Term")).when(q == 3, joined(years, " Term 3")).otherwise(F.col("o_orderpriority"))
    folder = joined(years, "_T3", F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").otherwise(""))
    return terms(spark, sf).select("o_orderkey", T.parse_term(text, folder).alias("t")).select("o_orderkey", "t.year_start", "t.year_end", "t.term", "t.acad_term_id")


@query("""
SELECT doc_id, md5(regexp_replace(replace(replace(text, ',', '•'), '.', '…'), '^[[:space:]]+|[[:space:]]+$', '', 'g')) AS cleaned FROM documents""")
def mojibake_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Commas and stops of whole texts as mis-read bytes, and hard spaces' halves before them."""
    broken = F.replace(F.replace("text", F.lit(","), F.lit("Ââ€¢")), F.lit("."), F.lit("â€¦Â"))
    return table(spark, sf, "documents").select("doc_id", F.md5(T.repair_encoding(broken)).alias("cleaned"))


@query("""
SELECT conv_id, turn, md5(CASE WHEN trim(regexp_replace(coalesce(text, 'None'), '[[:space:]]+', ' ', 'g')) = '' THEN '-' ELSE trim(regexp_replace(coalesce(text, 'None'), '[[:space:]]+', ' ', 'g')) END) AS cell,
       CASE WHEN role = 'system' THEN '0' ELSE coalesce(role, 'None') END AS bid FROM conversations""")
def cell_clean(spark: SparkSession, sf: str) -> DataFrame:
    spaced = F.replace("text", F.lit(" "), F.lit("  "))
    bid = F.when(F.col("role") == "system", " - ").otherwise(joined("  ", F.col("role"), "\n"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(T.clean_cell(spaced)).alias("cell"), T.clean_cell(bid, bid=True).alias("bid"))


@query("""
WITH i AS (SELECT page_id, url, list_transform(regexp_extract_all(regexp_replace(html, '</?a[^>]*>', '', 'g'), '<li[^>]*>([^<]+)</li>', 1), lambda x: trim(x)) AS l FROM pages)
SELECT page_id, CASE WHEN len(l) > 0 THEN array_to_string(l, ', ') END AS items, url FROM i""")
def html_pieces(spark: SparkSession, sf: str) -> DataFrame:
    bare = F.regexp_replace("html", "</?a[^>]*>", "")
    script = joined("track(1);window.open('", F.col("url"), "','w')")
    return table(spark, sf, "pages").select("page_id", T.list_items(bare).alias("items"), T.opened_url(script).alias("url"))


@query(f"""
WITH o AS (SELECT *, {TERMS} FROM orders)
SELECT o_orderkey, y::INTEGER AS acad_term_boss_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END::INTEGER AS class_boss_id, 'AY' || y || yy || 'T' || q || CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE '' END AS term FROM o""")
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    number = F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(s("o_custkey"))
    path = joined("/d/SelectedClassNumber=7/", F.col("o_orderpriority"), "/SelectedAcadTerm=", F.col("y"), "S&SelectedClassNumber=", number, ".html")
    source = joined(F.col("o_orderpriority"), "_AY", F.col("y"), F.col("yy"), "T", F.col("q"), F.when(F.col("o_orderstatus") == "F", "A").otherwise(""), "_", F.col("o_custkey"), ".csv")
    return terms(spark, sf).select("o_orderkey", *fields(T.file_ids(path), "acad_term_boss_id", "class_boss_id"), T.source_term(source).alias("term"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN (p_size % 9) || 'A' WHEN 3 THEN NULL ELSE (p_size % 9)::VARCHAR END AS round, CASE WHEN p_partkey % 4 = 3 THEN -1 ELSE p_size % 10 END::INTEGER AS "window",
       p_partkey % 4 = 1 AS freshmen, p_partkey % 4 = 2 AS exchange, p_type AS subject, (p_size * 7)::VARCHAR AS number,
       CASE WHEN p_size * 7 > 9 THEN left((p_size * 7)::VARCHAR, 1)::INTEGER ELSE 0 END AS difficulty, CASE WHEN p_size * 7 > 9 THEN substr((p_size * 7)::VARCHAR, 2)::INTEGER ELSE 0 END AS topic FROM part""")
def legacy_features(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    text = (
        F.when(k == 0, joined("Round ", size % 9, "A Window ", size % 10)).when(k == 1, joined("Incoming Freshmen Rnd ", size % 9, " Win ", size % 10))
        .when(k == 2, joined("Incoming Exchange Round ", size % 9, " Window ", size % 10)).otherwise(F.col("p_name"))
    )
    window, course = T.legacy_window(text), T.legacy_course(joined(F.col("p_type"), size * 7))
    return table(spark, sf, "part").select("p_partkey", *fields(window, "round", "window", "freshmen", "exchange"), *fields(course, "subject", "number", "difficulty", "topic"))


#: First and last word of a part's name in the SQL.
WORDS = "split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b"


def word(n: int) -> Column:
    return F.get(F.split("p_name", " "), F.lit(n))


@query(f"""
WITH p AS (SELECT *, {WORDS}, p_partkey % 10 AS k FROM part), c AS (SELECT *, upper(left(a, 1)) || lower(substr(a, 2)) AS shown_a, upper(left(b, 1)) || lower(substr(b, 2)) AS shown_b FROM p)
SELECT p_partkey, CASE WHEN k = 4 THEN upper(a || ' bin ' || b) WHEN k = 5 THEN upper(a || ' van ' || b) WHEN k = 6 THEN upper('tan ' || a || ' ' || b) WHEN k = 7 THEN upper('john tan ' || b) WHEN k = 8 THEN upper(b || ' amy ' || a)
         WHEN k = 9 THEN CASE WHEN p_size % 2 = 0 THEN 'UNKNOWN' ELSE upper(a) END WHEN k IN (2, 3) OR p_size % 2 = 0 THEN upper(p_name) ELSE upper(b || ', ' || a) END AS boss_name,
       CASE WHEN k = 4 THEN shown_a || ' bin ' || upper(b) WHEN k = 5 THEN shown_a || ' VAN ' || upper(b) WHEN k = 6 THEN 'TAN ' || shown_a || ' ' || shown_b WHEN k = 7 THEN 'John TAN ' || shown_b WHEN k = 8 THEN upper(b) || ' Amy ' || shown_a
         WHEN k = 9 THEN CASE WHEN p_size % 2 = 0 THEN 'Unknown' ELSE shown_a END WHEN k IN (2, 3) OR p_size % 2 = 0 THEN shown_a || ' ' || upper(b) ELSE upper(b) || ' ' || shown_a END AS display_name,
       CASE WHEN k = 4 THEN shown_a || ' ' || shown_b ELSE CASE WHEN a = b THEN upper(a) ELSE shown_a END || ' ' || upper(b) END AS shown FROM c""")
def name_normaliser(spark: SparkSession, sf: str) -> DataFrame:
    """Parts' names by every rule: plain, turned round, with an initial, in brackets, a father's name, a particle, known surnames and given names, one word, none; surnames that the name doesn't hold."""
    k, a, b, name = F.col("p_partkey") % 10, word(0), word(1), F.col("p_name")
    plain = F.when(F.col("p_size") % 2 == 0, name).otherwise(joined(b, ", ", a))
    forms = [plain, plain, joined(a, " q. ", b), joined(name, " (visiting)"), joined(a, " bin ", b), joined(a, " van ", b), joined("tan ", a, " ", b), joined("john tan ", b), joined(b, " amy ", a), F.when(F.col("p_size") % 2 == 1, a)]
    whole = F.get(F.array(*forms), k.cast("int"))
    surname = F.when(k == 4, "zz").otherwise(b)
    return table(spark, sf, "part").select("p_partkey", *fields(NM.normalise(whole, ("JOHN", "AMY")), "boss_name", "display_name"), NM.with_surname(name, surname).alias("shown"))


@query(f"""
WITH p AS (SELECT *, {WORDS} FROM part)
SELECT p_partkey, CASE WHEN a IN ('red', 'small') OR NOT (a IN ('blue', 'large') AND b NOT IN ('ring', 'bolt')) THEN 'WESTERN' ELSE 'ASIAN' END AS pattern,
       CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN list_has_all([a, b], [p_type]) ELSE a = b END AS alike FROM p""")
def name_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Names by first words; whether a name fits one with more words, another text, or its own first word twice."""
    other = F.when(F.col("p_size") % 3 == 0, joined(F.col("p_type"), " ", word(1), ", ", word(0))).when(F.col("p_size") % 3 == 1, F.col("p_type")).otherwise(joined(word(0), " ", word(0), ",x"))
    pattern = NM.pattern(F.col("p_name"), ("RED", "SMALL", "RING", "BOLT"), ("BLUE", "LARGE"))
    return table(spark, sf, "part").select("p_partkey", pattern.alias("pattern"), NM.names_match(F.col("p_name"), other).alias("alike"))


@query(f"""
WITH p AS (SELECT *, {WORDS} FROM part)
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 95 WHEN 1 THEN CASE WHEN a = b THEN 95 ELSE 100 END WHEN 2 THEN 0 ELSE 95 END::INTEGER AS score FROM p""")
def fuzzy_score(spark: SparkSession, sf: str) -> DataFrame:
    """Names in longer ones, with their words turned round, against nothing, and against themselves in capitals."""
    k = F.col("p_size") % 4
    other = F.when(k == 0, joined(F.col("p_brand"), " ", F.col("p_name"), ", x")).when(k == 1, joined(word(1), ",", word(0))).when(k == 3, F.upper("p_name"))
    return table(spark, sf, "part").select("p_partkey", NM.fuzzy_score(F.col("p_name"), other).alias("score"))


@query("""
SELECT p_partkey, lower(p_type) || '|' || p_size || ',brand#|' || substr(p_brand, 7) || ',' || p_name || '|-1' AS key FROM part""")
def natural_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = T.natural_key(joined(F.col("p_type"), F.col("p_size"), F.col("p_brand"), F.col("p_name")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(key, lambda p: F.concat_ws("|", p["t"], p["n"].cast("string"))), ",").alias("key"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size WHEN p_partkey % 3 = 1 THEN -p_size END AS whole, CASE WHEN p_partkey % 5 <> 0 THEN p_size / 4.0::DOUBLE END AS number, p_partkey % 2 = 0 AS uuid FROM part""")
def safe_numbers(spark: SparkSession, sf: str) -> DataFrame:
    k, size, h = F.col("p_partkey"), F.col("p_size"), F.md5(F.concat("p_name", s("p_partkey")))
    whole = F.when(k % 3 == 0, joined(" +", size, " ")).when(k % 3 == 1, joined("-", size)).otherwise(joined(size, ".5"))
    number = F.when(k % 5 != 0, joined(" ", size / 4, "\n")).otherwise(F.col("p_brand"))
    dashed = F.regexp_replace(h, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-4$3-a$4-$5")
    return table(spark, sf, "part").select("p_partkey", T.safe_int(whole).alias("whole"), T.safe_float(number).alias("number"), T.is_uuid(F.when(k % 2 == 0, joined(" ", F.upper(dashed))).otherwise(h)).alias("uuid"))


@query(f"""
WITH o AS (SELECT *, {TERMS} FROM orders)
SELECT o_orderkey, array_to_string(list_transform(range(y, y + q - 1), lambda x: x || '-' || lpad(((x + 1) % 100)::VARCHAR, 2, '0')), ',') AS years FROM o""")
def academic_years(spark: SparkSession, sf: str) -> DataFrame:
    """From the order's year over as many years as its quarter has before it; none in the first."""
    first, end = joined(F.col("y"), "-", F.col("yy"), "_T1"), F.col("y") + F.col("q") - 2
    return terms(spark, sf).select("o_orderkey", F.array_join(T.year_range(first, joined(end, "-xx_T2")), ",").alias("years"))


@query("""
WITH o AS (SELECT *, year(o_orderdate) + 30 AS y, quarter(o_orderdate) AS q, 1 + o_custkey % 4 AS w, CASE left(o_orderpriority, 1) WHEN '1' THEN '1' WHEN '2' THEN '1A' WHEN '3' THEN '1B' WHEN '4' THEN '2' ELSE '1F' END AS r,
  ['R1W1', 'R1AW1', 'R1AW2', 'R1AW3', 'R1BW1', 'R1BW2', 'R1CW1', 'R1CW2', 'R1CW3', 'R1FW1', 'R1FW2', 'R1FW3', 'R1FW4', 'R2W1', 'R2W2', 'R2W3', 'R2AW1', 'R2AW2', 'R2AW3'] AS l FROM orders),
b AS (SELECT *, CASE WHEN list_position(l, 'R' || r || 'W' || w) > 1 THEN l[list_position(l, 'R' || r || 'W' || w) - 1] END AS before FROM o)
SELECT o_orderkey, CASE WHEN q = 3 THEN CASE WHEN r = '1' THEN w WHEN r = '2' AND w <= 2 THEN 4 + w END
  WHEN r = '1B' AND w <= 2 THEN 4 + w WHEN r = '2' AND w <= 3 THEN 9 + w WHEN r = '1F' THEN 15 + w
  WHEN y + 1 < 2025 THEN CASE WHEN r = '1' AND w <= 2 THEN w WHEN r = '1A' AND w <= 2 THEN 2 + w END
  ELSE CASE WHEN r = '1' AND w = 1 THEN 1 WHEN r = '1A' AND w <= 3 THEN 1 + w END END::INTEGER AS place,
  regexp_extract(before, '^R(.+)W', 1) AS before_round, regexp_extract(before, 'W(.)$', 1)::INTEGER AS before_window,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE day(o_orderdate) END::INTEGER AS day, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE month(o_orderdate) END::INTEGER AS month FROM b""")
def window_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' priorities as rounds and customers as windows: places, the windows before, and the days of dates."""
    y, p = F.year("o_orderdate") + 30, F.substring("o_orderpriority", 1, 1)
    round_ = F.when(p == "1", "1").when(p == "2", "1A").when(p == "3", "1B").when(p == "4", "2").otherwise("1F")
    o = table(spark, sf, "orders").withColumns({"y": y, "w": (F.col("o_custkey") % 4 + 1).cast("int"), "r": round_})
    term = joined("AY", F.col("y"), F.lpad(s((F.col("y") + 1) % 100), 2, "0"), "T", F.when(F.quarter("o_orderdate") == 3, "3A").otherwise(s(F.quarter("o_orderdate"))))
    before = T.window_before(joined(F.col("y"), "_T1_R", F.col("r"), "W", F.col("w")))
    date = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", T.window_place(term, F.col("r"), F.col("w")).alias("place"), before["round"].alias("before_round"), before["window"].alias("before_window"), *fields(T.date_parts(date), "day", "month"))
