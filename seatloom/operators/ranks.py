"""Exact quantiles and ranks of very large groups, by sketches that bracket them and counts that settle them.

No task holds a group: a mergeable sketch (``percentile_approx``) gives bounds, rows are counted below the bounds, and
only the values between two bounds, counted by value, are ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.runtime import materialise

#: Accuracy of the sketch for each share asked for, and at least: its ranks are off by at most a part in so many.
ACCURACY, LEAST_ACCURACY = 200, 2_000


def below(bounds: Column, size: int, v: Column) -> Column:
    """How many of the first ``size`` entries of a sorted array are smaller than v, by bisection where there are more than a few."""
    if size <= 4:
        return sum(((F.get(bounds, F.lit(i)) < v).cast("int") for i in range(size)), F.lit(0))
    widths = [1 << i for i in reversed(range(max(size, 1).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), lambda n, w: F.when((n + w <= size) & (F.get(bounds, n + w - 1) < v), n + w).otherwise(n))


def same_keys(keys: list[str], prefix: str) -> Column:
    return reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"{prefix}{k}")), keys, F.lit(True))


def renamed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float], accuracy: int | None = None, also: dict[str, Column] | None = None, slack: float | None = None) -> DataFrame:
    """Rows -> keys, n, q (array): the exact quantiles of a double at these shares, linear between neighbours; nulls are left out.

    All shares are served by one pass: a row is counted once, in the interval between two shares' bounds that bisection finds, and by its value only where it lies between
    the bounds of a share, which are about 6 / accuracy of a group. Intervals are summed up, then the values of each are ordered by itself. A share whose rank is not
    between its bounds is found anew between wider ones. ``also``: more aggregates of the groups, taken in the first pass.
    """
    order = sorted(set(shares))
    size = len(order)
    accuracy = accuracy or max(LEAST_ACCURACY, ACCURACY * size)
    also, slack = also or {}, slack or 3 / accuracy
    rows = df.withColumn("q_value", F.col(value).cast("double")).filter("q_value IS NOT NULL")
    edges = [min(1.0, max(0.0, p + side)) for side in (-slack, slack) for p in order]
    told = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("q_value").alias("q_min"), F.max("q_value").alias("q_max"), F.percentile_approx("q_value", edges, accuracy).alias("q_edges"), *[c.alias(k) for k, c in also.items()])
    # the ends of the data bound the ends, and all shares of a group so small that the slack is less than a few rows
    small = (F.col("n") * slack < 4) | F.lit(slack >= 0.5)
    ends = sum(p <= slack for p in order), sum(p < 1 - slack for p in order)
    low = F.transform(F.slice("q_edges", 1, size), lambda x, i: F.when(small | (i < ends[0]), F.col("q_min")).otherwise(x))
    high = F.transform(F.slice("q_edges", size + 1, size), lambda x, i: F.when(small | (i >= ends[1]), F.col("q_max")).otherwise(x))
    bounds = materialise(told.filter("n > 0").select(*keys, "n", low.alias("q_low"), high.alias("q_high"), *also), "bounds")
    own = renamed(bounds.drop(*also), keys, "b_")
    rows = rows.select(*keys, "q_value")
    met = rows.join(own, same_keys(keys, "b_")) if keys else rows.crossJoin(F.broadcast(own))  # one row
    v = F.col("q_value")
    spot = met.select(*keys, "n", below(F.col("q_high"), size, v).alias("i"), v, "q_low").filter(F.col("i") < size)
    counted = spot.groupBy(*keys, "n", "i", F.when(v >= F.get("q_low", F.col("i")), v).alias("at")).count()
    # level one: whole intervals; level two: the values of each
    along, inside = Window.partitionBy(*keys).orderBy("i"), Window.partitionBy(*keys, "i").orderBy(F.asc_nulls_first("at"))
    sums = counted.groupBy(*keys, "i").agg(F.sum("count").alias("total"))
    starts = renamed(sums.select(*keys, "i", (F.sum("total").over(along) - F.col("total")).alias("start")), [*keys, "i"], "s_")
    placed = counted.withColumn("after", F.sum("count").over(inside)).filter("at IS NOT NULL").join(starts, same_keys([*keys, "i"], "s_"))
    first, last = F.col("start") + F.col("after") - F.col("count"), F.col("start") + F.col("after")
    rank = lambda k: F.element_at(F.array(*map(F.lit, order)), k + 1) * (F.col("n") - 1)
    here = lambda r: (first <= r) & (r < last)
    places = F.sequence(F.lit(0), F.lit(size - 1))
    hits = F.concat(F.transform(F.filter(places, lambda k: here(F.floor(rank(k)))), lambda k: k * 2), F.transform(F.filter(places, lambda k: here(F.ceil(rank(k)))), lambda k: k * 2 + 1))
    found = placed.select(*keys, "n", F.explode(hits).alias("hit"), "at").groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("hit", "at"))).alias("q_hits"))
    value_at = lambda k: F.try_element_at("q_hits", k * 2) + (F.try_element_at("q_hits", k * 2 + 1) - F.try_element_at("q_hits", k * 2)) * (rank(k) - F.floor(rank(k)))
    of_share = F.transform(F.array(*[F.lit(order.index(p)) for p in shares]), value_at)
    every = renamed(bounds.select(*keys, *also), keys, "e_").join(found, same_keys(keys, "e_"), "left") if also else found
    done = materialise(every.select(*[F.col(f"e_{k}").alias(k) if also else F.col(k) for k in keys], "n", of_share.alias("q"), *also), "quantiles")
    lost = F.col("q").isNull() | F.exists("q", lambda x: x.isNull())
    missing = done.select(lost.alias("lost")).agg(F.count("*"), F.count(F.when(F.col("lost"), 1))).first()
    if not missing[1] and missing[0] == bounds.count():
        return done
    good = done.filter(~lost)
    again = df.join(renamed(bounds.select(*keys).join(renamed(good.select(*keys, F.lit(1).alias("ok")), keys, "g_"), same_keys(keys, "g_"), "left_anti"), keys, "a_"), same_keys(keys, "a_"), "left_semi") if keys else df
    return good.unionByName(quantiles(again, keys, value, shares, accuracy, also, slack * 8))


#: Values that one task orders.
RANGE_VALUES = 50_000


def counted_ranks(df: DataFrame, keys: list[str], value: str, ranges: int | None = None) -> DataFrame:
    """Rows -> keys, value, n (rows of that value), before (rows of the group with a smaller value).

    Values are counted first; a sketch cuts each group into ranges of about as many values (``RANGE_VALUES`` in the largest group, if ``ranges`` is left out), which are
    summed, then ordered one by one.
    """
    counts = materialise(df.select(*keys, F.col(value)).filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n")), "counts")
    if ranges is None:
        most = counts.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        ranges = max(8, -(-most // RANGE_VALUES))
    cuts = renamed(counts.groupBy(*keys).agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 50 * ranges).alias("cuts")), keys, "r_")
    met = counts.join(cuts, same_keys(keys, "r_")) if keys else counts.crossJoin(F.broadcast(cuts))  # one row
    placed = met.select(*keys, value, "n", below(F.col("cuts"), ranges - 1, F.col(value)).alias("range"))
    sums = placed.groupBy(*keys, "range").agg(F.sum("n").alias("total"))
    along = Window.partitionBy(*keys).orderBy("range")
    sums = renamed(sums.withColumn("earlier", F.sum("total").over(along) - F.col("total")), [*keys, "range"], "s_")
    inside = Window.partitionBy(*keys, "range").orderBy(value)
    joined = placed.withColumn("upto", F.sum("n").over(inside)).join(sums, same_keys([*keys, "range"], "s_"))
    return joined.select(*keys, value, "n", (F.col("earlier") + F.col("upto") - F.col("n")).alias("before"))


def dense_ids(rows: DataFrame, first: str, rest: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """Distinct rows numbered from 1 in the order of ``first``, a number, then ``rest``."""
    before = counted_ranks(rows, [], first, ranges).select(F.col(first).alias("d_first"), "before")
    inside = Window.partitionBy(first).orderBy(*rest)
    return rows.withColumn("d_place", F.row_number().over(inside)).join(before, F.col(first) == F.col("d_first")).withColumn(name, (F.col("before") + F.col("d_place")).cast("int")).drop("d_first", "before", "d_place")


def ks_distance(df: DataFrame, value: str, distribution) -> DataFrame:
    """One row, ``ks``: the largest distance of the data's distribution from ``distribution``, a function of a column."""
    ranks = counted_ranks(df, [], value)
    total = ranks.agg(F.sum("n").alias("total"))
    at = ranks.crossJoin(F.broadcast(total)).withColumn("f", distribution(F.col(value)))  # one row
    return at.agg(F.max(F.greatest(F.col("f") - F.col("before") / F.col("total"), (F.col("before") + F.col("n")) / F.col("total") - F.col("f"))).alias("ks"))


def median_of(df: DataFrame, keys: list[str], value: str, name: str, also: dict[str, Column] | None = None) -> DataFrame:
    """Rows -> keys, n, the exact median, and more aggregates of the groups."""
    return quantiles(df, keys, value, [0.5], also=also).select(*keys, "n", F.get("q", F.lit(0)).alias(name), *(also or {}))


def interpolated(column: Column, share: float) -> Column:
    """A quantile within one array, for groups that are small by nature."""
    s = F.sort_array(column)
    at = share * (F.size(s) - 1)
    low = F.floor(at).cast("int")
    return F.get(s, low) + (F.get(s, F.ceil(at).cast("int")) - F.get(s, low)) * (at - low)
