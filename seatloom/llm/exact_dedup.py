"""Exact dedup by skew-safe combining, with DataFrame functions only.

Texts are equal when they are identical after A-Z are lower-cased. Three stages combine copies, each grouping by digest **and** whole text:

1. local: the partial aggregation of a task leaves one row for each text it has read, whatever its copies;
2. salted: these rows meet by (digest, salt, text). Hot digests, those of more than one in ``HOT`` rows, are dealt over ``SALTS`` salts
   by the task they come from; all others have one salt and are settled here, so most texts are shuffled once;
3. global: the salts' winners of hot digests, ``HOT * SALTS`` rows at most, are combined.

Results go back to the rows by digest alone, which is exact as long as no digest has two texts. This is counted: where the settled texts
outnumber the digests, the run starts again with whole texts as keys. Hot groups, fewer than ``HOT``, come to their rows by broadcast, the others by a
join in which no key holds more than one in ``HOT`` rows.

Defined cases: a null text counts as empty, so null and empty texts are one group; of equal texts the row of largest doc_id stays, a null doc_id is
below all others; of rows that repeat with that doc_id one stays, the first as read; an empty table gives an empty result; ``dedup`` keeps other columns, whatever their names, ``groups`` ignores them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm import columns as C
from seatloom.runtime import materialise

#: A digest of more than one in HOT rows is hot; each of these is dealt over SALTS groups.
HOT, SALTS = 512, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; empty for null. Pure ASCII takes the fast way, with the same result."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def contents(texts: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows (key, norm, doc_id) and the hot keys -> key, keep_id, group_size: one row for each text, by the three stages."""
    marked = texts.join(F.broadcast(hot.select("key", F.lit(True).alias("hot"))), "key", "left")
    salt = F.when(F.col("hot"), F.spark_partition_id() % SALTS).otherwise(0)
    groups = marked.withColumn("salt", salt).groupBy("key", "salt", "hot", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    salted = materialise(groups.select("key", F.when(F.col("hot"), F.col("norm")).alias("norm"), "keep_id", "group_size"), "salted")
    whole = salted.filter("norm IS NOT NULL").groupBy("key", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    columns = ["key", "keep_id", "group_size"]
    return materialise(salted.filter("norm IS NULL").select(columns).unionByName(whole.select(columns)), "contents")


def judge(docs: DataFrame, digest: Callable[[Column], Column] = sha256, hot_share: int = HOT) -> DataFrame:
    """Rows (tag, doc_id, text), tags unique -> tag, doc_id, keep_id, group_size, kept, sha (binary) for each row."""
    texts = docs.withColumn("norm", normalised(F.col("text"))).withColumn("key", digest(F.col("norm")))
    rows = materialise(texts.select("tag", "doc_id", "key", sha256(F.col("norm")).alias("sha")), "rows")
    sizes = materialise(rows.groupBy("key").count(), "sizes")
    total, keys = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    hot = materialise(sizes.filter(F.col("count") * hot_share > total), "hot")
    combined = contents(texts.select("key", "norm", "doc_id"), hot)
    if combined.count() != keys:
        return judge(docs, lambda text: text, hot_share)
    firsts = rows.groupBy(F.col("key").alias("r_key"), "doc_id").agg(F.min("tag").alias("keep_tag"))
    winners = combined.join(firsts, (F.col("key") == F.col("r_key")) & F.col("keep_id").eqNullSafe(F.col("doc_id")))
    winners = materialise(winners.select("key", "keep_id", "group_size", "keep_tag"), "winners")
    largest = F.broadcast(winners.filter(F.col("group_size") * hot_share > total))
    settled = rows.join(largest, "key").unionByName(rows.join(F.broadcast(hot), "key", "left_anti").join(winners, "key"))
    return settled.select("tag", "doc_id", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"), "sha")


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, hot_share: int = HOT) -> DataFrame:
    """Documents -> doc_id, keep_id, group_size, kept, text_sha256 (hex) for each row, dropped ones too."""
    rows = judge(docs.select(F.monotonically_increasing_id().alias("tag"), "doc_id", "text"), digest, hot_share)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, hot_share: int = HOT) -> DataFrame:
    """The documents that stay, all columns. The documents are written once, so tags name the same rows in every read."""
    tagged = materialise(C.hidden(docs).withColumn("tag", F.monotonically_increasing_id()), "tagged")
    kept = judge(tagged.select("tag", C.own("doc_id").alias("doc_id"), C.own("text").alias("text")), digest, hot_share).filter("kept")
    return C.shown(tagged.join(kept.select("tag"), "tag", "left_semi"), docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d
"""
