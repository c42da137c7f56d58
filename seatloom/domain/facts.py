"""Facts from raw rows: classes and their changes, timings, exams, availability, results, predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.domain import dims
from seatloom.functions import text as T
from seatloom.operators import names as N
from seatloom.operators import tables as op
from seatloom.operators.reconcile import reconcile


def professors_of_records(multiple: DataFrame, people: DataFrame) -> DataFrame:
    """Meeting rows (record_key, position, professor_name) and people (id, alias) -> record_key, professor_id, place: each person once, by first place."""
    rows = multiple.filter(~T.is_unset(F.col("professor_name"))).select("record_key", "position", "professor_name")
    listed = rows.select(F.col("professor_name").alias("raw")).distinct()
    split = N.split_names(listed, "raw", "raw", people, "alias").select("raw", F.posexplode("people").alias("sub", "name"))
    known = N.resolve(split.select("name").distinct(), "name", "name", people, "id", "alias").filter("id IS NOT NULL").select("name", "id")
    met = rows.join(split.join(known, "name"), F.col("professor_name") == F.col("raw"))
    return met.groupBy("record_key", F.col("id").alias("professor_id")).agg(F.min(F.struct("position", "sub")).alias("place"))


def class_changes(raw: DataFrame, professors: DataFrame, courses: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows, professors of records, courses (id, code) and existing classes -> changed classes with ``action``, and record_key -> class_id.

    A section's first row gives its fields and takes its classes. A section is marked inaccurate when a row of it has several professors. Sections of
    unknown courses, and rows without term, number or record, are left out.
    """
    keyed = raw.dropna(subset=["acad_term_id", "class_boss_id", "record_key"])
    wanted = ["acad_term_id", "class_boss_id", "record_key", "course_code", "section", "grading_basis", "course_outline_url", "position"]
    first = op.first_per_key(keyed.select(*wanted), ["acad_term_id", "class_boss_id"], [F.col("position")])
    first = first.join(courses.select(F.col("id").alias("course_id"), F.col("code").alias("course_code")), "course_code")
    met = keyed.select("acad_term_id", "class_boss_id", "record_key", F.col("position").alias("row")).join(professors, "record_key", "left")
    incoming = met.select(F.col("acad_term_id").alias("term"), F.col("class_boss_id").cast("long").alias("boss_id"), F.struct("row", "place").alias("position"), "professor_id")
    several = met.groupBy("acad_term_id", "class_boss_id", "row").agg(F.count("professor_id").alias("n")).groupBy("acad_term_id", "class_boss_id").agg((F.max("n") > 1).alias("warn"))
    known = incoming.join(first.select(F.col("acad_term_id").alias("term"), F.col("class_boss_id").cast("long").alias("boss_id")), ["term", "boss_id"], "left_semi")
    old = classes.select(F.col("acad_term_id").alias("term"), F.col("boss_id").cast("long").alias("boss_id"), F.col("id").alias("class_id"), "professor_id")
    acted = reconcile(old, known).withColumnRenamed("professor_id", "new_professor")
    j = acted.join(first.withColumnRenamed("section", "new_section"), (F.col("term") == F.col("acad_term_id")) & (F.col("boss_id") == F.col("class_boss_id"))).join(several, ["acad_term_id", "class_boss_id"])
    before = classes.select(F.col("id").alias("class_id"), F.col("section").alias("o_section"), F.col("grading_basis").alias("o_grading"), F.col("course_outline_url").alias("o_url"), F.col("warn_inaccuracy").alias("o_warn"), F.col("course_id").alias("o_course"))
    j = j.join(before, "class_id", "left")
    create, gone = F.col("action") == "create", F.col("action") == "deactivate"
    differs = ~F.col("grading_basis").eqNullSafe(F.col("o_grading")) | ~F.col("course_outline_url").eqNullSafe(F.col("o_url")) | ~F.col("new_section").eqNullSafe(F.col("o_section")) | ~F.col("warn").eqNullSafe(F.col("o_warn"))
    fresh = T.stable_id(F.lit("class"), F.col("acad_term_id"), F.col("boss_id"), F.col("new_professor"))
    j = j.withColumn("id", F.when(create, fresh).otherwise(F.col("class_id")))
    field = lambda new, old: F.when(gone, F.col(old)).otherwise(F.col(new))
    changed = j.filter(create | gone | (F.col("action") == "update") | differs).select(
        F.when(create | gone, F.col("action")).otherwise("update").alias("action"), "id", field("new_section", "o_section").alias("section"), F.coalesce("o_course", "course_id").alias("course_id"),
        F.col("new_professor").alias("professor_id"), "acad_term_id", field("grading_basis", "o_grading").alias("grading_basis"), field("course_outline_url", "o_url").alias("course_outline_url"),
        F.col("boss_id").cast("int").alias("boss_id"), F.when(gone, F.coalesce("o_warn", F.lit(False))).otherwise(F.col("warn")).alias("warn_inaccuracy"),
    )
    return changed, j.filter(~gone).select("record_key", F.col("id").alias("class_id"))


def current_classes(classes: DataFrame, changes: DataFrame) -> DataFrame:
    """Existing classes with the changes laid over them."""
    return op.overlay(classes, changes.drop("action"), ["id"], [F.col("section")])


def timings(multiple: DataFrame, record_classes: DataFrame, existing: DataFrame) -> DataFrame:
    """Class meetings of every class of their record whose five-part key isn't known; a missing type column means CLASS."""
    rows = multiple.filter(dims.column_or(multiple, "type", F.lit("CLASS")) == "CLASS").join(record_classes, "record_key")
    parts = ["day_of_week", "start_time", "end_time", "venue"]
    keyed = lambda df: df.withColumns({f"k_{p}": F.coalesce(p, F.lit("")) for p in parts})
    keys = ["class_id", *[f"k_{p}" for p in parts]]
    fresh = keyed(rows).join(keyed(existing).select(*keys), keys, "left_anti")
    return fresh.select("class_id", "start_date", "end_date", "day_of_week", "start_time", "end_time", F.coalesce("venue", F.lit("")).alias("venue"))


def exams(multiple: DataFrame, record_classes: DataFrame, existing: DataFrame) -> DataFrame:
    """Exams of every class of their record that has none yet."""
    rows = multiple.filter(dims.column_or(multiple, "type", F.lit("CLASS")) == "EXAM").join(record_classes, "record_key")
    fresh = rows.join(existing.select("class_id"), "class_id", "left_anti")
    return fresh.select("class_id", "date", "day_of_week", F.coalesce("start_time", F.lit("")).alias("start_time"), F.coalesce("end_time", F.lit("")).alias("end_time"), "venue")


def in_window(raw: DataFrame, window: str | None, term: str | None = None) -> DataFrame:
    """Rows of a window by its exact text, and of a term where one is given; none without a window, all where the table has no such column."""
    if window is None:
        return raw.limit(0)
    rows = raw.filter(F.col("bidding_window") == window) if "bidding_window" in raw.columns else raw
    return rows.filter(F.col("acad_term_id") == term) if term and "acad_term_id" in raw.columns else rows


def to_windows(rows: DataFrame, windows: DataFrame, term: Column) -> DataFrame:
    """Rows with ``bid_window_id``, by term and parsed window; others go."""
    parsed = rows.withColumns({"w_term": term, "w": T.parse_window(F.col("bidding_window"))})
    known = windows.select(F.col("id").alias("bid_window_id"), F.col("acad_term_id").alias("v_term"), F.col("round").alias("v_round"), F.col("window").alias("v_window"))
    met = parsed.join(known, (F.col("w_term") == F.col("v_term")) & (F.col("w.round") == F.col("v_round")) & (F.col("w.window") == F.col("v_window")))
    return met.drop("w", "w_term", "v_term", "v_round", "v_window")


def to_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (acad_term_id, class_boss_id) once for every class of their section."""
    known = classes.select(F.col("id").alias("class_id"), F.col("acad_term_id").alias("c_term"), F.col("boss_id").alias("c_boss"))
    return rows.join(known, (F.col("acad_term_id") == F.col("c_term")) & (F.col("class_boss_id") == F.col("c_boss"))).drop("c_term", "c_boss")


def availability(raw: DataFrame, classes: DataFrame, windows: DataFrame, existing: DataFrame, window: str | None, term: str | None = None) -> DataFrame:
    """Seats of the current window for every class of a section, missing ones 0, without those known by class and window."""
    rows = in_window(raw, window, term).dropna(subset=["course_code", "section", "acad_term_id", "bidding_window"])
    met = to_classes(to_windows(rows, windows, F.col("acad_term_id")), classes).join(existing.select("class_id", "bid_window_id"), ["class_id", "bid_window_id"], "left_anti")
    return met.select("class_id", "bid_window_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "current_enrolled", "reserved", "available")])


def results_of_previous(results: DataFrame, courses: DataFrame, classes: DataFrame, windows: DataFrame, existing: DataFrame, window: str | None, term: str) -> tuple[DataFrame, DataFrame]:
    """Published results of the previous window for every class of a section -> new and updated bid results."""
    rows = in_window(results, window).filter("course_code IS NOT NULL AND course_code != ''").withColumn("acad_term_id", F.lit(term))
    sections = classes.join(courses.select(F.col("id").alias("course_id"), "code"), "course_id").select(F.col("id").alias("class_id"), F.col("acad_term_id").alias("s_term"), F.col("section").alias("s_section"), "code")
    met = to_windows(rows, windows, F.lit(term)).join(sections, (F.col("acad_term_id") == F.col("s_term")) & (F.col("course_code") == F.col("code")) & (F.col("section") == F.col("s_section")))
    whole = ("vacancy", "opening_vacancy", "before_process_vacancy", "d_i_c_e", "after_process_vacancy", "enrolled_students")
    made = met.select("bid_window_id", "class_id", *[T.safe_int(F.col(c)).alias(c) for c in whole], T.safe_float(F.col("median_bid")).alias("median"), T.safe_float(F.col("min_bid")).alias("min"))
    known = existing.select("bid_window_id", "class_id")
    return made.join(known, ["bid_window_id", "class_id"], "left_anti"), made.join(known, ["bid_window_id", "class_id"], "left_semi")


def placeholders(raw: DataFrame, classes: DataFrame, windows: DataFrame, existing: DataFrame, window: str | None, term: str | None = None) -> DataFrame:
    """Bid results without bids for the current window, where there is none yet: vacancy is the total, before processing the total less the enrolled."""
    rows = in_window(raw, window, term).dropna(subset=["acad_term_id", "class_boss_id"])
    met = to_classes(to_windows(rows, windows, F.col("acad_term_id")), classes).join(existing.select("class_id", "bid_window_id"), ["class_id", "bid_window_id"], "left_anti")
    none = lambda kind: F.lit(None).cast(kind)
    return met.select(
        "bid_window_id", "class_id", F.col("total").alias("vacancy"), none("int").alias("opening_vacancy"), (F.col("total") - F.col("current_enrolled")).alias("before_process_vacancy"),
        none("int").alias("d_i_c_e"), none("int").alias("after_process_vacancy"), F.col("current_enrolled").alias("enrolled_students"), none("double").alias("median"), none("double").alias("min"),
    )


def predictions(scores: DataFrame, raw: DataFrame, classes: DataFrame, windows: DataFrame, version: str) -> DataFrame:
    """Scores by record_key, fanned out to every class of the record's section."""
    fields = ["clf_has_bids_prob", "clf_confidence_score", "median_predicted", "median_uncertainty", "min_predicted", "min_uncertainty"]
    met = to_classes(to_windows(raw.join(scores.select("record_key", *fields), "record_key"), windows, F.col("acad_term_id")), classes)
    return met.select("class_id", "bid_window_id", F.lit(version).alias("model_version"), *fields)


def late_windows(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Windows that facts (acad_term_id, bidding_window) name and no dimension row holds, numbered on: known rows and these."""
    return known.select("id", "acad_term_id", "round", "window").unionByName(dims.bid_windows(facts, known))
