"""Operators on whole tables: keep-first and keep-latest, change detection, surrogate keys, runs, as-of lookup, bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.operators import ranks


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    """The first row (or ``most`` rows) of each key in ``order``; Spark cuts to them before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= most).drop("_place")


def overlay(snapshot: DataFrame, changes: DataFrame, keys: list[str], tiebreak: list[Column]) -> DataFrame:
    """Snapshot and changes, changes winning by key (upsert)."""
    both = snapshot.withColumn("_tier", F.lit(1)).unionByName(changes.withColumn("_tier", F.lit(0)), allowMissingColumns=True)
    return first_per_key(both, keys, [F.col("_tier"), *tiebreak]).drop("_tier")


def differs(new: Column, old: Column, ignore_missing: bool = False) -> Column:
    """Null-aware inequality of trimmed text; with ``ignore_missing`` a missing new value is no change."""
    changed = ~F.trim(new.cast("string")).eqNullSafe(F.trim(old.cast("string")))
    return changed & new.isNotNull() if ignore_missing else changed


def surrogate_ids(new: DataFrame, order: list[Column], start: int, name: str) -> DataFrame:
    """Dense ids after ``start`` in the given order. For dimension rows: one row a member, not one a fact."""
    return new.withColumn(name, (F.row_number().over(Window.orderBy(*order)) + start).cast("int"))


def runs(df: DataFrame, keys: list[str], order: list[Column], flag: Column, name: str) -> DataFrame:
    """Length so far of the run of rows with ``flag``; 0 where it is unset."""
    w = Window.partitionBy(*keys).orderBy(*order)
    island = df.withColumn("_flag", flag.cast("int")).withColumn("_island", F.sum(1 - F.col("_flag")).over(w))
    inside = Window.partitionBy(*keys, "_island").orderBy(*order)
    return island.withColumn(name, F.sum("_flag").over(inside)).drop("_flag", "_island")


#: Most rows of a schedule that travels as one array.
SCHEDULE_ROWS = 2_000


def as_of(facts: DataFrame, at: str, schedule: DataFrame, ts: str, value: str, most: int = SCHEDULE_ROWS) -> DataFrame:
    """Facts with ``current`` (value of the first schedule row after ``at``) and ``previous`` (the row before it, the last if none is left).

    A schedule of up to ``most`` rows (they are counted) travels as one sorted array, so facts are neither joined nor shuffled. A longer one meets the
    facts in buckets of a day: inside a bucket by order, beyond it by the nearest schedule rows of other buckets.
    """
    if schedule.limit(most + 1).count() <= most:
        rows = schedule.select(F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))).alias("_s"))
        gone = F.size(F.filter("_s", lambda s: s["t"] <= F.col(at)))
        return (
            facts.crossJoin(F.broadcast(rows))  # one row
            .withColumn("_n", gone)
            .withColumn("current", F.get(F.col("_s"), F.col("_n"))["v"])
            .withColumn("previous", F.get(F.col("_s"), F.col("_n") - 1)["v"])
            .drop("_s", "_n")
        )
    bucket = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 86_400_000_000)
    held = schedule.select(bucket(ts).alias("s_bucket"), F.col(ts).alias("s_t"), F.col(value).alias("s_v"))
    ends = held.groupBy("s_bucket").agg(F.max_by("s_v", "s_t").alias("last"), F.min_by("s_v", "s_t").alias("first"))
    buckets = facts.select(bucket(at).alias("s_bucket")).distinct().join(ends, "s_bucket", "full")
    along = Window.orderBy("s_bucket")  # a row a day
    carried = buckets.select(
        F.col("s_bucket").alias("c_bucket"), F.last("last", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("c_previous"),
        F.first("first", True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("c_current"),
    )
    both = facts.withColumns({"s_bucket": bucket(at), "s_t": F.col(at), "s_v": F.lit(None).cast(schedule.schema[value].dataType), "s_fact": F.lit(1)}).unionByName(held.withColumn("s_fact", F.lit(0)), allowMissingColumns=True)
    # at equal times the schedule's row stands first, as it is gone by then
    order = Window.partitionBy("s_bucket").orderBy("s_t", "s_fact")
    told = both.withColumns({"previous": F.last("s_v", True).over(order.rowsBetween(Window.unboundedPreceding, -1)), "current": F.first("s_v", True).over(order.rowsBetween(1, Window.unboundedFollowing))})
    found = told.filter("s_fact = 1").join(carried, F.col("s_bucket") == F.col("c_bucket"), "left")
    return found.withColumns({"current": F.coalesce("current", "c_current"), "previous": F.coalesce("previous", "c_previous")}).select(*facts.columns, "current", "previous")


def quartile_bounds(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """One row: low and high bounds, ``reach`` interquartile ranges beyond the quartiles."""
    q = ranks.quantiles(df, [], column, [0.25, 0.75])
    return q.select((F.col("q")[0] - reach * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + reach * (F.col("q")[1] - F.col("q")[0])).alias("high"))
