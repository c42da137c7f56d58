"""Incremental runs over a folder that files arrive in: each run takes the files that no run has taken, and writes nothing twice.

A file stream with a checkpoint lists what is new; ``availableNow`` ends it when that is done. Each micro-batch is one version of the target
(``versions.Versions``) under the label of its number, so a batch that is run again after a failure finds its label and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.operators import tables as op
from seatloom.sources.versions import Versions


def take(
    spark: SparkSession,
    folder: str,
    schema: str,
    target: str,
    table: str,
    checkpoint: str,
    kind: str = "parquet",
    files_per_batch: int = 1000,
    options: dict[str, str] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Take the new files of a folder into a table; returns the numbers of the versions that were added.

    Rows carry ``source_file``. ``prepare`` turns a batch's rows into the table's; whatever it raises ends the run, and the next run takes the same files again.
    ``files_per_batch`` bounds a batch, not what is taken.
    """
    log, added = Versions(spark, target), []

    def add(rows: DataFrame, number: int) -> None:
        rows = rows if prepare is None else prepare(rows)
        if (version := log.commit([(table, "new", rows)], f"{checkpoint}#{number}")) is not None:
            added.append(version)

    stream = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**(options or {})).load(folder)
    named = stream.withColumn("source_file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    query = named.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return added


def latest(spark: SparkSession, target: str, table: str, keys: list[str], order: list[str] | None = None, number: str | None = None) -> DataFrame | None:
    """Of each key the row that came last: of the newest version, then by ``order``, the largest; None before the first run. ``number``: a column for its version."""
    rows = Versions(spark, target).read(table)
    if rows is None:
        return None
    found = op.first_per_key(rows, keys, [F.desc("_version"), *[F.desc(c) for c in order or []]]).drop("_kind")
    return found.withColumnRenamed("_version", number) if number else found.drop("_version")
