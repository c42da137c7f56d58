"""Writing results: CSV of a fixed contract, append of new rows, upsert by swap, and partitions written once.

Every write goes through Spark's commit protocol, so a lost executor leaves no half-written table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

from seatloom.operators import tables as op
from seatloom.sources.versions import Conflict, Versions

SHEET_KEY = ["acad_term_id", "course_code", "section", "bidding_window"]


def contract(df: DataFrame, columns: list[str]) -> DataFrame:
    """The contract's columns as CSV can hold them: lists as JSON, timestamps in ISO form."""

    def shown(name: str):
        kind = df.schema[name].dataType
        if isinstance(kind, ArrayType):
            return F.to_json(name).alias(name)
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss").alias(name) if isinstance(kind, TimestampType) else F.col(name)

    return df.select(*map(shown, columns))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> bool:
    """A folder of CSV parts with a header; nothing is written for no rows."""
    if df.isEmpty():
        return False
    contract(df, columns).write.mode("overwrite").csv(path, header=True, escape='"')
    return True


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append rows whose key the table does not hold yet, one for each key of equal rows. A row with a null in its key is always appended."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    fresh = df.filter(whole).dropDuplicates(keys).unionByName(df.filter(~whole))
    if exists(df.sparkSession, path):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(*keys), keys, "left_anti")
    fresh.write.mode("append").parquet(path)


def upsert(snapshot_path: str, changes: DataFrame, keys: list[str], target_path: str) -> None:
    """The snapshot with changes laid over it, written as a new version beside the one that is read."""
    snapshot = changes.sparkSession.read.parquet(snapshot_path)
    rest = [F.col(c) for c in changes.columns if c not in keys]
    op.overlay(snapshot, changes, keys, rest).write.mode("errorifexists").parquet(target_path)


def write_once(df: DataFrame, path: str, column: str, value: str) -> bool:
    """Write one partition of a table unless it is there; tells whether it was written."""
    target = f"{path}/{column}={value}"
    if exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    df.drop(column).write.mode("overwrite").parquet(target)
    return True


def merge_sheets(standalone: DataFrame, multiple: DataFrame, errors: DataFrame, folder: str, label: str, tries: int = 3) -> int | None:
    """Three sheets of raw rows merged into those of ``folder`` as one version; returns its number, or None for a label that is there.

    Standalone rows are appended unless their four-part key is there; the rows of a record in ``multiple`` replace those it had, unless they are the same; errors are
    appended. Where another run changes the sheets meanwhile, the merge is made again from what it left, ``tries`` times at most.
    """
    log = Versions(standalone.sparkSession, folder)
    for left in reversed(range(tries)):
        base = log.latest()
        new, old = standalone, log.read("standalone", base)
        whole = reduce(lambda a, k: a & F.col(k).isNotNull(), SHEET_KEY, F.lit(True))
        new = new.filter(whole).dropDuplicates(SHEET_KEY).unionByName(new.filter(~whole))
        new = new if old is None else new.join(old.select(*SHEET_KEY), SHEET_KEY, "left_anti")
        changed, held = multiple, read_multiple(log.spark, folder, base)
        if held is not None:
            same = lambda df: df.groupBy("record_key").agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(multiple.columns)).cast("decimal(38,0)")).alias("h"))
            changed = changed.join(same(multiple).join(same(held), ["record_key", "n", "h"], "left_semi").select("record_key"), "record_key", "left_anti")
        try:
            return log.commit([("standalone", "new", new), ("multiple", "updated", changed), ("errors", "new", errors)], label, base)
        except Conflict:
            if not left:
                raise
    return None


def read_multiple(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """The rows that ``merge_sheets`` left of each record: those of its newest version."""
    rows = Versions(spark, folder).read("multiple", version)
    if rows is None:
        return None
    newest = rows.groupBy("record_key").agg(F.max("_version").alias("_version"))
    return rows.join(newest, ["record_key", "_version"]).drop("_version", "_kind")
