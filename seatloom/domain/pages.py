"""Class pages to records: one standalone row a page, its meetings, and errors beside them. No Python per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.runtime import materialise

#: Element ids of a class page.
HEADER, TERM, NAME, DESCRIPTION = "lblClassInfoHeader", "lblClassInfoSubHeader", "lblClassSection", "lblCourseDescription"
UNITS, AREAS, REQUIREMENTS, GRADING = "lblUnits", "lblCourseAreas", "lblEnrolmentRequirements", "lblGradingBasis"
OUTLINE, DATES, MEETINGS = "imgCourseOutline", "lblDates", "RadGrid_MeetingInfo_ctl00"
SEATS = {"total": "lblClassCapacity", "current_enrolled": "lblEnrolmentTotal", "reserved": "lblReserved", "available": "lblAvailableSeats"}


#: Fixed by HTML: elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def cleaned(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", ""), r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)", " ")


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def inner(html: Column, name: str) -> Column:
    """Inner HTML of the first element with an id, up to the end tag that closes it; null where there is none.

    Elements of the same name inside it are counted: its end is the first end tag with as many start tags before it as end tags. Without one, the rest of the page is inside.
    """
    form = rf"(?is)<([a-z][a-z0-9]*)\b[^>]*?\bid\s*=\s*[\"']?{name}[\"']?(?:\s[^>]*)?>"
    found = F.struct(F.regexp_extract(html, form, 0).alias("start"), F.lower(F.regexp_extract(html, form, 1)).alias("tag"))

    def within(f: Column) -> Column:
        start, tag = f["start"], f["tag"]
        opening = F.concat(F.lit("(?i)<"), tag, F.lit(r"(?=[\s>/])"))

        def step(s: Column, piece: Column) -> Column:
            def after(opened: Column) -> Column:
                closed = opened == s["ends"]
                return F.struct(F.when(closed, s["ends"]).otherwise(s["ends"] + 1).alias("ends"), opened.alias("opened"), closed.alias("closed"))

            return F.when(s["closed"], s).otherwise(let(s["opened"] + F.regexp_count(piece, opening), after))

        begun = F.struct(F.lit(0).alias("ends"), F.lit(0).alias("opened"), F.lit(False).alias("closed"))
        pieces = F.split(F.substr(html, F.instr(html, start) + F.length(start)), F.concat(F.lit("(?i)</"), tag, F.lit(r"\s*>")))
        inside = let(pieces, lambda p: F.call_function("array_join", F.slice(p, 1, F.aggregate(p, begun, step)["ends"] + 1), F.concat(F.lit("</"), tag, F.lit(">"))))
        return F.when(start != "", F.when(tag.isin(*VOID), "").otherwise(inside))

    return let(found, within)


def flat(html: Column) -> Column:
    """A table's inner HTML with tables inside it turned to plain text, so its rows and cells are its own."""

    def step(s: Column, piece: Column) -> Column:
        depth = F.greatest(F.lit(0), s["depth"] + F.when(piece.rlike(r"(?i)^<table\b"), 1).when(piece.rlike(r"(?i)^</table\b"), -1).otherwise(0))
        text = F.regexp_replace(piece, r"(?i)^</?table\b[^>]*>", " ")
        return F.struct(depth.alias("depth"), F.concat(s["out"], F.when(depth > 0, F.regexp_replace(text, r"(?s)<[^>]+>", " ")).otherwise(text)).alias("out"))

    return F.aggregate(F.split(html, r"(?i)(?=</?table\b)"), F.struct(F.lit(0).alias("depth"), F.lit("").alias("out")), step)["out"]


def numbered(text: Column) -> Column:
    """Numeric character references decoded; what is no character becomes U+FFFD."""

    def character(piece: Column) -> Column:
        reference = F.substring_index(piece, ";", 1)
        code = F.when(reference.rlike("^[xX]"), F.conv(F.substring(reference, 2, 8), 16, 10)).otherwise(reference).cast("long")
        bad = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF) | (code == 0)
        return F.concat(F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32"), F.substr(piece, F.length(reference) + 2))

    def joined(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, 1 << 30), character), ""))

    return let(text, lambda t: F.when(t.contains("&#"), let(F.split(t, "&#(?=[0-9]{1,7};|[xX][0-9A-Fa-f]{1,6};)"), joined)).otherwise(t))


def plain(html: Column) -> Column:
    """Text of a piece of HTML: tags gone, references decoded, white space collapsed; null where nothing is left."""
    t = numbered(F.regexp_replace(html, r"(?s)<[^>]+>", " "))
    for reference, character in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(reference), F.lit(character))
    return let(T.repair_encoding(F.regexp_replace(t, r"[\s\u00a0]+", " ")), lambda x: F.when(x != "", x))


def text_of(html: Column, name: str) -> Column:
    return plain(inner(html, name))


def grading(text: Column) -> Column:
    """Graded, Pass/Fail or NA; null for no text."""
    low = F.lower(text)
    return F.when(text.isNull() | (text == ""), None).when(low == "graded", "Graded").when(low.isin("pass/fail", "pass fail"), "Pass/Fail").otherwise("NA")


def window_of(pages: DataFrame, windows: DataFrame, folder: Column) -> DataFrame:
    """Pages with ``bidding_window``: the name that the schedule (abbreviation, window) gives the folder's last part, else that part."""
    part = F.element_at(F.split(folder, "_"), -1)
    names = windows.select(F.col("abbreviation").alias("w_part"), F.col("window").alias("w_name")).dropDuplicates(["w_part"])
    return pages.withColumn("w_own", part).join(names, F.col("w_own") == F.col("w_part"), "left").withColumn("bidding_window", F.coalesce("w_name", "w_own")).drop("w_own", "w_part", "w_name")


def folder_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def standalone(pages: DataFrame, windows: DataFrame, extracted: str) -> DataFrame:
    """Pages (filepath, html) that have a class header -> the standalone record; ``extracted`` is the time of extraction."""
    h, path = F.col("html"), F.col("filepath")
    wanted = {"header_text": HEADER, "term_text": TERM, "course_name": NAME, "course_description": DESCRIPTION, "units": UNITS, "requirements": REQUIREMENTS, "grading": GRADING, "period_text": DATES, **SEATS}
    outline = F.regexp_extract(h, rf"(?is)<[^>]*\bid\s*=\s*[\"']?{OUTLINE}[\"'\s][^>]*>", 0)
    # the texts are written once, and what is read from them is not worked into the search for them
    texts = pages.withColumn("html", cleaned(h)).select("filepath", *[text_of(h, e).alias(n) for n, e in wanted.items()], inner(h, AREAS).alias("areas"), outline.alias("outline"))
    texts = materialise(texts.filter("header_text IS NOT NULL"), "page-texts")
    folder = F.try_element_at(F.split(path, "/"), F.lit(-2))
    found = window_of(texts, windows, F.coalesce(folder, F.lit("")))
    read = found.withColumns({"header": T.parse_header(F.col("header_text")), "ids": T.file_ids(path), "t": T.parse_term(F.col("term_text"), folder)})
    period = r"(\d{1,2}-\w{3}-\d{4})\s+to\s+(\d{1,2}-\w{3}-\d{4})"
    return read.select(
        F.element_at(F.split(path, "/"), -1).alias("record_key"), "filepath", "header.course_code", "header.section", "course_name", "course_description", T.safe_float(F.col("units")).alias("credit_units"),
        F.coalesce(T.list_items(F.col("areas")), plain(F.col("areas"))).alias("course_area"), F.col("requirements").alias("enrolment_requirements"), "t.acad_term_id",
        F.col("t.year_start").alias("acad_year_start"), F.col("t.year_end").alias("acad_year_end"), "t.term",
        T.date_text(T.found(F.col("period_text"), period, 1)).alias("start_dt"), T.date_text(T.found(F.col("period_text"), period, 2)).alias("end_dt"), grading(F.col("grading")).alias("grading_basis"),
        T.opened_url(F.col("outline")).alias("course_outline_url"), "ids.acad_term_boss_id", "ids.class_boss_id", "term_text", "period_text",
        *[T.whole_number(F.col(n)).alias(n) for n in SEATS], F.lit(extracted).alias("date_extracted"), "bidding_window",
    )


def errors(pages: DataFrame) -> DataFrame:
    """Pages without a class header, and pages with one but without meetings -> filepath, error, type."""
    h = F.col("html")
    pages = pages.withColumn("html", cleaned(h))
    what = F.when(text_of(h, HEADER).isNull(), "Missing class header").when(~h.rlike(rf"(?i)id\s*=\s*[\"']?{MEETINGS}\b"), "Error extracting meeting information")
    return pages.select("filepath", what.alias("error"), F.lit("parse_error").alias("type")).filter("error IS NOT NULL")


def meetings(pages: DataFrame) -> DataFrame:
    """Pages -> a row for each class meeting or exam; an end tag of a row or cell may be missing, tables inside a cell are its text; rows of fewer than seven cells are no meetings, an exam's date is its end date."""
    h = F.col("html")
    pages = pages.withColumn("html", cleaned(h))
    body = F.regexp_extract(flat(inner(h, MEETINGS)), r"(?is)<tbody\b[^>]*>(.*?)(?:</tbody\s*>|\z)", 1)
    pieces = lambda html, tag: F.slice(F.split(html, rf"(?i)<{tag}\b[^>]*>"), 2, 1 << 30)
    rows = pages.filter(text_of(h, HEADER).isNotNull()).select(F.element_at(F.split("filepath", "/"), -1).alias("record_key"), F.explode(pieces(body, "tr")).alias("row"))
    cells = F.transform(pieces(F.col("row"), "td"), lambda c: F.coalesce(plain(F.regexp_replace(c, r"(?is)</t[dr]\s*>.*", "")), F.lit("")))
    cut = rows.select("record_key", cells.alias("c")).filter(F.size("c") >= 7)
    c = lambda i: F.get("c", F.lit(i))
    kind = F.coalesce(F.nullif(c(0), F.lit("")), F.lit("CLASS"))
    lesson = F.col("type") == "CLASS"
    return cut.withColumn("type", kind).filter(F.col("type").isin("CLASS", "EXAM")).select(
        "record_key", "type", F.when(lesson, T.date_text(c(1))).alias("start_date"), F.when(lesson, T.date_text(c(2))).alias("end_date"), F.when(~lesson, T.date_text(c(2))).alias("date"),
        c(3).alias("day_of_week"), c(4).alias("start_time"), c(5).alias("end_time"), c(6).alias("venue"), F.coalesce(c(7), F.lit("")).alias("professor_name"),
    )
