"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Inside its source, documents are range-sorted by that key,
a distributed prefix sum of their sizes is taken, and the source is cut at its exact word budget;
budgets above a source's size repeat whole epochs first.

The prefix sum runs in two levels. Keys are hexadecimal digests, so a prefix of the key is a range:
level one sums sizes for each (source, range), level two sorts rows only inside the one range of each
source in which the cut falls. A source that holds a third of all rows is thus spread over all ranges.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last; rows that
repeat are separate documents; the key is a hash of doc_id or, where that is null, of the text; rows with equal keys are ordered by
doc_id, then size; empty input gives empty output; documents of size 0 take 0. Other input columns are ignored, or kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.llm import columns as C
from seatloom.runtime import materialise

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """Source sizes -> source, source_size, target.

    Weights repeat over the sources in code point order. Targets share the total by weight; a target
    above ``cap`` times its source's size stops there and the rest is shared anew. Sorted by cap per
    weight, the capped sources are a prefix, so one ordered pass over the sources settles it. This
    pass has one row a source, not one a document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    by_source = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(
        by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    ranked = by_source.withColumn("total", F.sum("source_size").over(everything).cast("double")).withColumn("level", level)
    # the first source whose share stays within its limit fixes the level for all that follow
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    final = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(everything)["level"]
    share = F.coalesce(final * F.col("weight"), F.col("limit"))
    return ranked.select("source", "source_size", F.least(share, F.col("limit")).alias("target"))


def keyed(docs: DataFrame, column=F.col) -> DataFrame:
    """Documents with ``m_id``, ``m_source``, ``m_size`` and ``m_key``, the hash-random key; ``column`` reads one of theirs."""
    text = column("text")
    key = F.md5(F.coalesce(column("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit("")))))
    return docs.withColumns({"m_id": column("doc_id"), "m_source": column("source"), "m_size": word_count(text), "m_key": key})


def cuts_of(sized: DataFrame, digits: int, weights: tuple[int, ...], cap: float) -> DataFrame:
    """For each range of each source: epochs that all its documents get, words left for it, whether the cut falls into it."""
    ranges = sized.groupBy(F.col("m_source").alias("source"), F.substring("m_key", 1, digits).alias("range")).agg(F.sum("m_size").alias("range_size"))
    ranges = materialise(ranges, "ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, cap)
    along = Window.partitionBy("source").orderBy("range")
    budget = F.floor(F.col("target")).cast("long")
    cuts = (
        ranges.withColumn("before", F.sum("range_size").over(along) - F.col("range_size"))
        .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size") - F.col("before"))
        .select(
            F.col("source").alias("c_source"), F.col("range").alias("c_range"), F.col("source_size").alias("c_size"), F.col("target").alias("c_target"),
            F.col("epochs").alias("c_epochs"), F.col("rest").alias("c_rest"), ((F.col("rest") > 0) & (F.col("rest") < F.col("range_size"))).alias("c_split"),
        )
    )
    return materialise(cuts, "cuts")


def taken_of(rows: DataFrame, cuts: DataFrame, digits: int) -> DataFrame:
    """Keyed rows with ``m_taken`` and the columns of their cut; only ranges in which a cut falls are sorted."""
    placed = rows.join(cuts, F.col("m_source").eqNullSafe(F.col("c_source")) & (F.substring("m_key", 1, digits) == F.col("c_range")))
    inside = Window.partitionBy("m_source", "c_range").orderBy("m_key", "m_id", "m_size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("c_rest") - F.coalesce(F.sum("m_size").over(inside), F.lit(0))
    cut = placed.filter("c_split").withColumn("m_part", F.greatest(F.lit(0), F.least(left, F.col("m_size"))))
    whole = placed.filter("NOT c_split").withColumn("m_part", F.when(F.col("c_rest") > 0, F.col("m_size")).otherwise(0))
    return cut.unionByName(whole).withColumn("m_taken", (F.col("c_epochs") * F.col("m_size") + F.col("m_part")).cast("long"))


def digits_for(rows: int, rows_per_range: int) -> int:
    """Leading digits of the key that name a range of about so many rows."""
    return max(1, math.ceil(math.log(max(rows, 1) / rows_per_range + 1, 16)))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: float = 3.0,
    rows_per_range: int = 1000,
) -> DataFrame:
    """Documents -> doc_id, source, size, source_size, target, taken (words, repeats counted).

    ``rows_per_range`` sets how many ranges the keys are cut into; it changes no result.
    """
    sized = materialise(keyed(docs.select("doc_id", "source", "text")).drop("doc_id", "source", "text"), "sizes")
    digits = digits_for(sized.count(), rows_per_range)
    out = taken_of(sized, cuts_of(sized, digits, weights, cap), digits)
    return out.select(
        F.col("m_id").alias("doc_id"), F.col("m_source").alias("source"), F.col("m_size").alias("size"), F.col("c_size").alias("source_size"), F.col("c_target").alias("target"), F.col("m_taken").alias("taken")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, rows_per_range: int = 1000) -> DataFrame:
    """The mix itself: documents of which words are taken, all columns, and ``size``, ``taken`` after them.

    Texts stay where they are unless a cut falls into their range. Columns of the documents named size or taken give way.
    """
    columns = [c for c in docs.columns if c not in ("size", "taken")]
    rows = keyed(C.hidden(docs.select(*[F.col(f"`{c}`") for c in columns])), C.own)
    sized = materialise(rows.select("m_source", "m_size", "m_key"), "sizes")
    digits = digits_for(sized.count(), rows_per_range)
    out = taken_of(rows, cuts_of(sized, digits, weights, cap), digits).filter("m_taken > 0")
    return out.select(*[C.own(c).alias(c) for c in columns], F.col("m_size").alias("size"), F.col("m_taken").alias("taken"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, 3.0::DOUBLE * source_size AS lim, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
f AS (SELECT arg_min(level, lim / w) AS level FROM l WHERE level * w <= lim),
t AS (SELECT l.source, l.source_size, least(coalesce(f.level * w, lim), lim) AS target FROM l CROSS JOIN f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM p
"""
