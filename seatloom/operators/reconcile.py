"""Reconciling the classes of a section with its incoming professors: an order-bound fold over small groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# For each professor in incoming order: the (last) class of their own if it is unused, else the first unused class without
# professor, else the first unused class, else a new one. Classes left over lose their professor.
_FOLD = """
aggregate(asked, named_struct('used', cast(array() AS array<string>), 'out', cast(array() AS array<struct<class_id:string,professor_id:string,action:string>>)),
  (s, p) -> transform(array(filter(classes, c -> NOT array_contains(s.used, c.class_id))), free ->
    transform(array(coalesce(
      CASE WHEN NOT array_contains(s.used, coalesce(try_element_at(filter(classes, c -> c.professor_id <=> p), -1).class_id, ''))
        THEN try_element_at(filter(classes, c -> c.professor_id <=> p), -1).class_id END,
      get(filter(free, c -> c.professor_id IS NULL), 0).class_id, get(free, 0).class_id)), chosen ->
      named_struct('used', CASE WHEN chosen IS NULL THEN s.used ELSE concat(s.used, array(chosen)) END,
        'out', concat(s.out, array(named_struct('class_id', chosen, 'professor_id', p, 'action',
          CASE WHEN chosen IS NULL THEN 'create' WHEN get(filter(classes, c -> c.class_id = chosen), 0).professor_id <=> p THEN 'keep' ELSE 'update' END)))))[0])[0],
  s -> concat(s.out, transform(filter(classes, c -> NOT array_contains(s.used, c.class_id) AND c.professor_id IS NOT NULL),
    c -> named_struct('class_id', c.class_id, 'professor_id', cast(NULL AS string), 'action', 'deactivate'))))
"""


def reconcile(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing (term, boss_id, class_id, professor_id) and incoming (term, boss_id, position, professor_id) -> term, boss_id, class_id, professor_id, action.

    Groups without incoming rows are left alone. A professor counts once, at their first position; none (null) is asked for like a professor. An earlier
    professor without a class of their own can take one that a later professor holds. A group is one class section, a handful of
    rows; it travels as one row with two short arrays.
    """
    old = existing.groupBy(F.col("term").alias("e_term"), F.col("boss_id").alias("e_boss_id")).agg(F.array_sort(F.collect_list(F.struct("class_id", "professor_id"))).alias("classes"))
    new = incoming.groupBy("term", "boss_id").agg(F.array_sort(F.collect_list(F.struct("position", "professor_id"))).alias("asked"))
    groups = new.join(old, (F.col("term") == F.col("e_term")) & (F.col("boss_id") == F.col("e_boss_id")), "left")
    groups = groups.select(
        "term", "boss_id", F.array_distinct("asked.professor_id").alias("asked"), F.coalesce("classes", F.array().cast("array<struct<class_id:string,professor_id:string>>")).alias("classes")
    )
    return groups.select("term", "boss_id", F.inline(F.expr(_FOLD)))
