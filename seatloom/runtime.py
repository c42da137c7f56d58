"""Session helpers shared by operators: the shared scratch folder, lineage cuts, and the package for the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import seatloom

#: Tables written in the scopes that are open here, innermost last; threads have scopes of their own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A local folder stands in for it in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, so executors need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_seatloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(seatloom.__file__))
    if os.path.isdir(root):  # an archive has come by itself
        target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "seatloom.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(target)
    context._seatloom_shipped = True


def in_arrow(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` by workers that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def materialise(df: DataFrame, name: str, scoped: bool = True) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage and survives lost executors; unlike a cache it takes no executor memory,
    and later joins see its real size and can split its skewed partitions. ``scoped``: deleted at the end of the open scope.
    """
    ship(df.sparkSession)
    path = f"{scratch_dir(df.sparkSession)}/seatloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if scoped and (opened := _SCOPES.get()):
        opened[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these frames, once nothing reads it any more."""
    for df in frames:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/seatloom-" in folder:
                _delete(df.sparkSession, folder)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end. Results that are still read lazily must be written before, or outside."""
    written: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), written))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in written:
            _delete(spark, path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside; what is read lazily later isn't under it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
