"""The whole run: from raw rows and snapshots to new and changed rows of every table, and their ordered persistence."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.domain import dims, facts, safety, schemas
from seatloom.operators import tables as op
from seatloom.runtime import materialise
from seatloom.sources.versions import Versions

#: Tables in the order in which they are written: dimensions before facts.
ORDER = (
    "acad_terms", "courses", "professors", "bid_windows", "classes", "class_timings", "class_exam_timings", "class_availabilities", "bid_results", "bid_predictions", "safety_factors",
)
SNAPSHOTS = {
    "acad_terms": schemas.TERMS, "courses": schemas.COURSES, "professors": schemas.PROFESSORS, "bid_windows": schemas.BID_WINDOWS, "classes": schemas.CLASSES,
    "class_timings": schemas.TIMINGS, "class_exam_timings": schemas.EXAMS, "class_availabilities": schemas.AVAILABILITY, "bid_results": schemas.BID_RESULTS,
}


@dataclass
class Config:
    """What a run reads. Raw tables have ``position``; snapshots that are missing are empty."""

    acad_term_id: str
    standalone: DataFrame
    multiple: DataFrame
    results: DataFrame | None = None
    current_window: str | None = None
    previous_window: str | None = None
    snapshots: dict[str, DataFrame] = field(default_factory=dict)
    given_names: tuple[str, ...] = ()
    fallback_faculty: int = 1
    scores: DataFrame | None = None  # record_key and the models' outputs
    model_version: str = "v4"
    residuals: DataFrame | None = None  # prediction_type, residual


def run(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Table -> its rows; ``<table>_new`` and ``<table>_updated`` where a table has both."""
    old = {name: config.snapshots[name] if name in config.snapshots else spark.createDataFrame([], schema) for name, schema in SNAPSHOTS.items()}
    raw, multiple, term = config.standalone, config.multiple, config.acad_term_id
    out: dict[str, DataFrame] = {"acad_terms": dims.new_terms(raw, old["acad_terms"])}

    # what several tables are made of is written once, so plans stay small
    courses = materialise(dims.course_changes(raw, old["courses"], config.fallback_faculty), "course-changes")
    out["courses_new"], out["courses_updated"] = (courses.filter(F.col("action") == a).drop("action") for a in ("create", "update"))
    known_courses = old["courses"].select("id", "code").unionByName(out["courses_new"].select("id", "code"))

    new_people, changed_people = dims.professors(multiple, old["professors"], config.given_names)
    out["professors_new"], out["professors_updated"] = materialise(new_people, "professors-new"), materialise(changed_people, "professors-updated")
    people = old["professors"].select("id", "name", "boss_aliases").unionByName(out["professors_new"].select("id", "name", "boss_aliases"))
    people = people.unionByName(out["professors_updated"].select("id", "name", "boss_aliases"))
    out["professor_lookup"] = dims.alias_export(old["professors"], out["professors_updated"], out["professors_new"])

    explicit = [(term, w) for w in (config.current_window, config.previous_window) if w]
    expected = spark.createDataFrame(explicit, "acad_term_id string, bidding_window string") if explicit else None
    out["bid_windows"] = materialise(dims.bid_windows(raw, old["bid_windows"], expected), "bid-windows")
    windows = old["bid_windows"].unionByName(out["bid_windows"])

    aliases = materialise(dims.aliases_of(people).select("id", "alias").distinct(), "aliases")
    professors = materialise(facts.professors_of_records(multiple, aliases), "professors-of-records")
    changes, record_classes = facts.class_changes(raw, professors, known_courses, old["classes"])
    changes, record_classes = materialise(changes, "class-changes"), materialise(record_classes, "record-classes")
    out["classes_new"] = changes.filter("action = 'create'").drop("action")
    out["classes_updated"] = changes.filter("action != 'create'").drop("action")
    out["record_classes"] = record_classes
    classes = materialise(facts.current_classes(old["classes"], changes), "classes")

    out["class_timings"] = facts.timings(multiple, record_classes, old["class_timings"])
    out["class_exam_timings"] = facts.exams(multiple, record_classes, old["class_exam_timings"])
    out["class_availabilities"] = facts.availability(raw, classes, windows, old["class_availabilities"], config.current_window, term)
    new = facts.placeholders(raw, classes, windows, old["bid_results"], config.current_window, term)
    if config.results is not None and config.previous_window:
        fresh, changed = facts.results_of_previous(config.results, known_courses, classes, windows, old["bid_results"], config.previous_window, term)
        # a published result stands before a placeholder of its key
        new, out["bid_results_updated"] = fresh.unionByName(new.join(fresh.select("bid_window_id", "class_id"), ["bid_window_id", "class_id"], "left_anti")), changed
    out["bid_results_new"] = new
    if config.scores is not None:
        current = facts.in_window(raw, config.current_window, term)
        out["bid_predictions"] = facts.predictions(config.scores, current, classes, windows, config.model_version)
    if config.residuals is not None:
        out["safety_factors"] = safety.safety_factors(config.residuals, term)
    return out


KEYS = {"courses": ["id"], "professors": ["id"], "classes": ["id"], "bid_results": ["bid_window_id", "class_id"]}


def persist(results: dict[str, DataFrame], folder: str, label: str, base: int | None = None) -> list[str]:
    """Commit the run's tables as one version of ``folder``: all of them become visible, or none. Returns what was written, in order, dimensions before facts.

    A label that is there is not committed again, so a run can be repeated. ``base``: the version that the run's snapshots were read from.
    """
    rows = [(table, kind, results[key]) for table in ORDER for key, kind in ((table, "new"), (f"{table}_new", "new"), (f"{table}_updated", "updated")) if key in results]
    if not rows or Versions(rows[0][2].sparkSession, folder).commit(rows, label, base) is None:
        return []
    return [f"{table}/{kind}" for table, kind, _ in rows]


def current(spark: SparkSession, folder: str, table: str, snapshot: DataFrame, version: int | None = None) -> DataFrame:
    """A snapshot with all that was persisted laid over it, up to a version; of one key the row of the newest version stays."""
    rows = Versions(spark, folder).read(table, version)
    if rows is None:
        return snapshot
    keys = KEYS.get(table, [c for c in snapshot.columns if c == "id"] or snapshot.columns)
    both = snapshot.withColumns({"_version": F.lit(0).cast("long"), "_kind": F.lit("new")}).unionByName(rows, allowMissingColumns=True)
    return op.first_per_key(both, keys, [F.desc("_version"), F.desc("_kind")]).select(*snapshot.columns)
