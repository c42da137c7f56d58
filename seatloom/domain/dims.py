"""Dimensions from raw rows: terms, courses, bid windows, people. Raw rows have ``position``, their order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.functions import names as NM
from seatloom.functions import text as T
from seatloom.operators import names as N
from seatloom.operators import tables as op
from seatloom.runtime import materialise


def new_terms(raw: DataFrame, known: DataFrame) -> DataFrame:
    """First raw row of each term that isn't known, without the term's leading T."""
    first = op.first_per_key(raw.filter("acad_term_id IS NOT NULL"), ["acad_term_id"], [F.col("position")])
    fresh = first.join(known.select(F.col("id").alias("acad_term_id")), "acad_term_id", "left_anti")
    return fresh.select(
        F.col("acad_term_id").alias("id"), "acad_year_start", "acad_year_end", F.regexp_replace("term", "^T", "").alias("term"), F.col("acad_term_boss_id").alias("boss_id"), "start_dt", "end_dt"
    )


def majority_faculty(courses: DataFrame) -> DataFrame:
    """Known courses -> prefix, faculty: the most frequent of each code prefix, the smallest of equally frequent ones."""
    prefix = T.found(F.upper("code"), r"^([A-Z-]+)")
    counts = courses.filter("belong_to_faculty IS NOT NULL").groupBy(prefix.alias("prefix"), F.col("belong_to_faculty").alias("faculty")).count()
    return op.first_per_key(counts.filter("prefix IS NOT NULL"), ["prefix"], [F.desc("count"), F.col("faculty")]).select("prefix", "faculty")


def course_changes(raw: DataFrame, courses: DataFrame, fallback_faculty: int = 1) -> DataFrame:
    """Raw rows and known courses -> ``action`` (create, update) and the course: only those that are new or differ in one of five fields."""
    fields = {"name": "course_name", "description": "course_description", "credit_units": "credit_units", "course_area": "course_area", "enrolment_requirements": "enrolment_requirements"}
    first = op.first_per_key(raw.filter("course_code IS NOT NULL"), ["course_code"], [F.col("position")]).select("course_code", *[F.col(c).alias(f"n_{f}") for f, c in fields.items()])
    old = courses.select(F.col("id").alias("o_id"), "code", F.col("belong_to_faculty").alias("o_faculty"), *[F.col(f).alias(f"o_{f}") for f in fields])
    j = first.join(old, F.col("course_code") == F.col("code"), "left")
    j = j.join(majority_faculty(courses), T.found(F.upper("course_code"), r"^([A-Z-]+)") == F.col("prefix"), "left")
    changed = F.lit(False)
    for f in fields:
        changed = changed | op.differs(F.col(f"n_{f}"), F.col(f"o_{f}"))
    new = F.col("o_id").isNull()
    default = {"name": F.lit("Unknown Course"), "description": F.lit("No description available"), "credit_units": F.lit(1.0)}
    kept = [F.coalesce(f"n_{f}", f"o_{f}", d).alias(f) for f, d in default.items()]
    return j.filter(new | changed).select(
        F.when(new, "create").otherwise("update").alias("action"), F.coalesce("o_id", T.stable_id(F.lit("course"), F.col("course_code"))).alias("id"), F.col("course_code").alias("code"), *kept,
        F.lit(1).alias("belong_to_university"), F.when(new, F.coalesce("faculty", F.lit(fallback_faculty))).otherwise(F.coalesce("o_faculty", F.lit(fallback_faculty))).alias("belong_to_faculty"),
        F.col("n_course_area").alias("course_area"), F.col("n_enrolment_requirements").alias("enrolment_requirements"),
    )


def faculties_of_departments(rows: DataFrame, departments: DataFrame, faculties: DataFrame, courses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(course_code, department) rows, department -> acronym, acronym -> id, known courses -> (course_code, faculty) and the departments that lead to none."""
    pairs = rows.dropna(subset=["course_code", "department"]).select("course_code", F.upper(F.trim("department")).alias("department")).filter("department != ''").distinct()
    pairs = pairs.join(courses.select(F.col("code").alias("course_code")).distinct(), "course_code", "left_semi")
    j = pairs.join(departments.select("department", "acronym"), "department", "left").join(faculties.select(F.col("id").alias("faculty"), "acronym"), "acronym", "left")
    return j.filter("faculty IS NOT NULL").select("course_code", "faculty"), j.filter("faculty IS NULL").select("department").distinct()


def bid_windows(raw: DataFrame, known: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Windows in raw rows (acad_term_id, bidding_window) that aren't known, numbered on; ``expected``: further rows of that form."""
    rows = raw.select("acad_term_id", "bidding_window")
    rows = rows.unionByName(expected.select("acad_term_id", "bidding_window")) if expected is not None else rows
    found = rows.dropna().distinct().withColumn("w", T.parse_window(F.col("bidding_window"))).filter("w.window IS NOT NULL").select("acad_term_id", "w.round", "w.window").distinct()
    fresh = found.join(known, ["acad_term_id", "round", "window"], "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    order = Window.orderBy("acad_term_id", T.round_ordinal(F.col("round")), "round", "window")  # a row a window, a dimension
    return fresh.withColumn("place", F.row_number().over(order)).crossJoin(F.broadcast(top)).select((F.col("top") + F.col("place")).cast("int").alias("id"), "acad_term_id", "round", "window")


def renumbered(windows: DataFrame) -> DataFrame:
    """Windows expected in their term, with ids anew from 1 in the order of terms and of the windows in them; others go."""
    placed = windows.withColumn("place", T.window_place(F.col("acad_term_id"), F.col("round"), F.col("window"))).filter("place IS NOT NULL")
    return placed.withColumn("new_id", F.row_number().over(Window.orderBy("acad_term_id", "place"))).drop("place")


def aliases_of(people: DataFrame) -> DataFrame:
    """People (id, name, boss_aliases) -> id, name, alias: their name and every alias, upper-cased."""
    listed = F.filter(F.array_union(F.array(F.upper("name")), F.transform(F.coalesce("boss_aliases", F.array().cast("array<string>")), lambda a: F.upper(F.trim(a)))), lambda a: a != "")
    return people.select("id", "name", F.explode(listed).alias("alias"))


def professors(multiple: DataFrame, known: DataFrame, given: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Names in meeting rows and known people -> new people and known ones with new aliases.

    New ones have their names as aliases: as scraped, and normalised. Names that share a normalised form are one person.
    """
    aliases = aliases_of(known)
    listed = multiple.filter(~T.is_unset(F.col("professor_name"))).select(F.trim("professor_name").alias("raw")).distinct()
    people = N.split_names(listed, "raw", "raw", aliases, "alias").select(F.explode("people").alias("name")).filter(~T.is_unset(F.col("name"))).distinct()
    people = materialise(people, "names")
    people = people.withColumn("n", NM.normalise(F.col("name"), given)).select("name", F.col("n.boss_name").alias("boss_name"), F.col("n.display_name").alias("display_name"))
    people = materialise(people, "names-normalised")
    direct = N.resolve(people, "name", "name", aliases, "id", "alias").select("name", F.col("id").alias("direct"))
    by_form = N.resolve(people, "name", "boss_name", aliases, "id", "alias").select("name", F.col("id").alias("formed"))
    matched = materialise(people.join(direct, "name").join(by_form, "name").withColumn("id", F.coalesce("direct", "formed")), "names-matched")
    fresh = matched.filter("id IS NULL").groupBy("boss_name").agg(F.min_by("display_name", "name").alias("name"), F.min("name").alias("original_scraped_name"), F.collect_set(F.upper("name")).alias("seen"))
    new = fresh.select(
        T.stable_id(F.lit("professor"), F.col("boss_name")).alias("id"), "name", T.slug(F.col("name")).alias("slug"), F.array_sort(F.array_union(F.array("boss_name"), "seen")).alias("boss_aliases"), "original_scraped_name"
    )
    said = matched.filter("id IS NOT NULL").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.array(F.upper("name"), "boss_name")))).alias("said"))
    j = known.join(said, "id")
    added = F.array_except("said", F.transform(F.coalesce("boss_aliases", F.array().cast("array<string>")), lambda a: F.upper(a)))
    updated = j.withColumn("added", added).filter(F.size("added") > 0).withColumn("boss_aliases", F.array_sort(F.array_union(F.coalesce("boss_aliases", F.array().cast("array<string>")), "added")))
    return new, updated.drop("said", "added")


def alias_export(known: DataFrame, updated: DataFrame, new: DataFrame) -> DataFrame:
    """One row an alias: boss_name, afterclass_name, database_id, method (exists, updated, new)."""

    def rows(people: DataFrame, method: str) -> DataFrame:
        return people.select(F.col("alias").alias("boss_name"), F.col("name").alias("afterclass_name"), F.col("id").alias("database_id"), F.lit(method).alias("method"))

    only = lambda people: people.select("id", "name", F.explode(F.transform("boss_aliases", lambda a: F.upper(a))).alias("alias"))
    return rows(aliases_of(known), "exists").unionByName(rows(only(updated), "updated")).unionByName(rows(only(new), "new"))


def resolved_columns(columns: list[str], wanted: dict[str, list[str]]) -> dict[str, str]:
    """Names wanted -> the column that stands for each: the first alternative that a column equals but for case and punctuation, or whose words it holds."""
    bare = lambda c: "".join(ch for ch in c.lower() if ch.isalnum())
    out: dict[str, str] = {}
    for name, alternatives in wanted.items():
        exact = next((c for a in alternatives for c in columns if bare(c) == bare(a)), None)
        loose = next((c for a in alternatives for c in columns if all(w in c.lower() for w in a.lower().replace("_", " ").split())), None)
        if exact or loose:
            out[name] = exact or loose
    return out


def renamed(rows: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """The columns wanted, under their names; those that are missing are null."""
    found = resolved_columns(rows.columns, wanted)
    return rows.select(*[(F.col(f"`{found[n]}`") if n in found else F.lit(None).cast("string")).alias(n) for n in wanted])


def column_or(rows: DataFrame, name: str, default: Column) -> Column:
    """A column, or a default where the table lacks it; a null value stays null."""
    return F.col(name) if name in rows.columns else default
