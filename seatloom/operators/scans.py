"""Running sums, extremes, lags and runs over groups of any size, in two levels.

Rows are cut into ranges by (keys, order), so a hot group spreads over many ranges. Each range is scanned alone; a range's first group takes over what
the ranges before it hold of that group, which one row a range tells. No task sees more than a range of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seatloom.runtime import materialise

#: About so many rows a range, so a task's memory does not grow with the table.
ROWS = 500_000

#: How two parts of a group are put together; a part without rows is null.
MERGE = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest, "min": F.least}
WITHIN = {"sum": F.sum, "max": F.max, "min": F.min}


def running(df: DataFrame, keys: list[str], order: list[str | Column], scans: dict[str, tuple[str, Column]], current: bool = False, ranges: int | None = None) -> DataFrame:
    """Rows with one more column for each scan: ("sum" | "max" | "min", column) over the rows before this one in its group, with it if ``current``.

    ``order`` (ascending, nulls first; columns or expressions, which no shuffle carries) must tell a group's rows apart; the scan is null where there are no rows. ``ranges``: how many; one for each ``ROWS`` rows if left out.
    """
    values = {f"_v{i}": column for i, (_, column) in enumerate(scans.values())}
    kinds = [kind for kind, _ in scans.values()]
    by = [F.asc_nulls_first(c) for c in (*keys, *order)]
    # worked out where they are read, so neither shuffles nor the written table carry them
    derived = {**values, "_group": F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))}
    ranges = ranges or max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS))
    slim = materialise(df.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()), "scan-ranges")
    cut = slim.withColumns(derived)

    # one row a range, so as many as there are partitions
    ends = cut.groupBy("_range").agg(F.min("_group").alias("_first"), F.max("_group").alias("_last"))
    whole = [WITHIN[kind](v).alias(v) for kind, v in zip(kinds, values, strict=True)]
    last = cut.join(F.broadcast(ends), "_range").filter(F.col("_group") == F.col("_last"))
    # a largest struct would sort all rows, so only rows with the largest first field are asked for it
    heads = {v: F.col(v)[cut.schema[v].dataType.names[0]] for kind, v in zip(kinds, values, strict=True) if kind == "max" and isinstance(cut.schema[v].dataType, StructType)}
    plain = [a for a, v in zip(whole, values, strict=True) if v not in heads]
    tails = last.groupBy("_range", F.col("_last").alias("_key")).agg(F.count("*").alias("_n"), *plain, *[F.max(h).alias(f"_h{v}") for v, h in heads.items()])
    if heads:
        tails = materialise(tails, "scan-tails")
        top = {v: h.eqNullSafe(F.col(f"_h{v}")) for v, h in heads.items()}
        met = last.join(F.broadcast(tails.select("_range", *[f"_h{v}" for v in heads])), "_range").filter(reduce(Column.__or__, top.values()))
        tails = tails.join(met.groupBy("_range").agg(*[F.max(F.when(c, F.col(v))).alias(v) for v, c in top.items()]), "_range")
    tails = tails.select("_range", "_key", *values)

    asking = ends.select("_range", F.col("_first").alias("_key"), F.lit(True).alias("_asks"))
    so_far = Window.partitionBy("_key").orderBy("_range", F.desc("_asks")).rowsBetween(Window.unboundedPreceding, -1)
    met = asking.unionByName(tails.withColumn("_asks", F.lit(False)), allowMissingColumns=True)
    met = met.withColumns({f"_c{i}": WITHIN[kind](v).over(so_far) for i, (kind, v) in enumerate(zip(kinds, values, strict=True))})
    carried = met.filter("_asks").select("_range", F.col("_key").alias("_carry"), *[f"_c{i}" for i in range(len(kinds))])

    alone = Window.partitionBy("_range", "_group").orderBy(*[F.asc_nulls_first(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    # dealt by range and not by hash, so no task gets several by chance
    local = slim.repartitionByRange(ranges, "_range").withColumns(derived).withColumns({f"_l{i}": WITHIN[kind](v).over(alone) for i, (kind, v) in enumerate(zip(kinds, values, strict=True))})
    joined = local.join(F.broadcast(carried), "_range")
    taken = {name: MERGE[kind](F.col(f"_l{i}"), F.when(F.col("_group") == F.col("_carry"), F.col(f"_c{i}"))) for i, (name, kind) in enumerate(zip(scans, kinds, strict=True))}
    return joined.select(*df.columns, *[c.alias(name) for name, c in taken.items()])


def lagged(df: DataFrame, keys: list[str], order: list[str], column: str, name: str, ranges: int | None = None) -> DataFrame:
    """Rows with ``column`` of the row before in its group; null for the first."""
    last = F.struct(*order, F.col(column).alias("_value"))
    return running(df, keys, order, {"_before": ("max", last)}, ranges=ranges).withColumn(name, F.col("_before._value")).drop("_before")


def runs(df: DataFrame, keys: list[str], order: list[str], flag: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Length so far of the run of rows with ``flag``; 0 where it is unset or null."""
    set_rows = F.coalesce(flag, F.lit(False)).cast("long")
    counted = running(df.withColumn("_flag", set_rows), keys, order, {"_upto": ("sum", F.col("_flag"))}, True, ranges)
    ended = F.when(F.col("_flag") == 0, F.col("_upto"))  # counts never fall, so the largest is the last
    found = running(counted, keys, order, {"_ended": ("max", ended)}, True, ranges)
    return found.withColumn(name, F.col("_upto") - F.coalesce("_ended", F.lit(0))).drop("_flag", "_upto", "_ended")
