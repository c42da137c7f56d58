"""Keeps the documents' own columns apart from those an operator adds, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Begins the names that the documents' columns have inside an operator.
PREFIX = "doc:"


def hidden(docs: DataFrame) -> DataFrame:
    """Every column under a name no operator uses; ``own`` reads it."""
    return docs.toDF(*[PREFIX + c for c in docs.columns])


def own(name: str):
    """A column of hidden documents."""
    return F.col(f"`{PREFIX}{name}`")


def shown(rows: DataFrame, names: list[str], **changed) -> DataFrame:
    """The documents' columns under their own names again, in order; ``changed`` gives some another value."""
    return rows.select(*[changed.get(c, own(c)).alias(c) for c in names])
