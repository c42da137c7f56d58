"""Reading files of a folder: several with their origin, CSV that may be missing, JSON schedules, and only what is new."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.runtime import in_arrow


def origin() -> Column:
    """Name of the table a row was read from, whether that is a file or a folder of part files."""
    return F.regexp_extract("_metadata.file_path", r"([^/]+)\.parquet", 1)


def scan(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows of all parquet files, read as one table; ``source_file`` tells which. Files that can't be read are skipped."""
    rows = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).schema(schema).parquet(*paths)
    return rows.select("*", origin().alias("source_file"))


def read_csv(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """CSV with a header; no rows where the path is missing or empty, or a required column is not in its header."""
    empty = spark.createDataFrame([], schema)
    try:
        header = spark.read.csv(path, header=True, escape='"').columns
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty
    if not set(required) <= set(header):
        return empty
    rows = spark.read.csv(path, header=True, escape='"')
    return rows.select(*[(F.col(f.name) if f.name in header else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in empty.schema])


def schedule(texts: DataFrame, text: str) -> DataFrame:
    """JSON texts ``{term: [[timestamp, window, abbreviation], ...]}`` -> term, seq, at, window, abbreviation; bad JSON gives no rows."""
    terms = texts.select(F.explode(F.from_json(text, "map<string,array<array<string>>>")).alias("term", "entries"))
    entries = terms.select("term", F.posexplode("entries").alias("seq", "e"))
    return entries.select("term", "seq", F.try_to_timestamp(F.get("e", F.lit(0))).alias("at"), F.get("e", F.lit(1)).alias("window"), F.get("e", F.lit(2)).alias("abbreviation"))


def unseen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't among those seen."""
    return rows.join(seen.select(*keys), keys, "left_anti")


def csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder as one table; each file has its own header, columns that a file lacks are null."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).filter("length > 0").select("path").orderBy("path")
    parts = [spark.read.csv(r.path, header=True, escape='"').withColumn("source_file", F.element_at(F.split(F.lit(r.path), "/"), -1)) for r in listed.collect()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else spark.createDataFrame([], "source_file string")


_NUMBER = re.compile(r"[0-9]+")


def _place(cell: str) -> int:
    """Column number of a cell like BC12."""
    n = 0
    for letter in _NUMBER.sub("", cell):
        n = n * 26 + ord(letter) - 64
    return n - 1


def _sheet(book: bytes, wanted: str | None) -> list[dict[str, str]]:
    """Rows of a workbook's sheet (the first without a name), by the header in its first row; all values as text."""
    name = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        parse = lambda path: ElementTree.fromstring(z.read(path)) if path in z.namelist() else ElementTree.Element("none")
        shared = ["".join(t.text or "" for t in si.iter() if name(t) == "t") for si in parse("xl/sharedStrings.xml") if name(si) == "si"]
        targets = {r.get("Id"): r.get("Target", "") for r in parse("xl/_rels/workbook.xml.rels")}
        sheets = [(s.get("name"), next((v for k, v in s.attrib.items() if k.endswith("}id")), "")) for s in parse("xl/workbook.xml").iter() if name(s) == "sheet"]
        chosen = next((i for n, i in sheets if wanted is None or n == wanted), None)
        if chosen is None:
            return []
        rows: list[list[str | None]] = []
        for row in (e for e in parse("xl/" + targets.get(chosen, "").removeprefix("/xl/")).iter() if name(e) == "row"):
            cells: list[str | None] = []
            for c in (e for e in row if name(e) == "c"):
                at = _place(c.get("r", "")) if c.get("r") else len(cells)
                kind, value = c.get("t"), next((v.text for v in c if name(v) == "v"), None)
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if name(t) == "t")
                elif kind == "s" and value is not None:
                    value = shared[int(value)]
                cells += [None] * (at + 1 - len(cells))
                cells[at] = value
            rows.append(cells)
    head = [h or f"column_{i}" for i, h in enumerate(rows[0])] if rows else []
    return [dict(zip(head, r, strict=False)) for r in rows[1:]]


def workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Rows of a sheet of every workbook (.xlsx) at a path or in a folder: source_file, row, cells (map of texts).

    A workbook is read by the task that holds it. Files that are no workbooks, and missing paths, give no rows.
    """
    result = "source_file string, row int, cells map<string,string>"
    try:
        books = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("source_file", pa.string()), ("row", pa.int32()), ("cells", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for file, book in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = _sheet(book, sheet)
                except (zipfile.BadZipFile, ElementTree.ParseError, ValueError, IndexError):
                    rows = []
                found = [{"source_file": file.rpartition("/")[2], "row": i, "cells": list(r.items())} for i, r in enumerate(rows)]
                yield pa.RecordBatch.from_pylist(found, kind)

    return in_arrow(books, run, result)


def snapshot(spark: SparkSession, path: str, load: Callable[[], DataFrame] | None = None) -> DataFrame:
    """The snapshot at a path; where there is none, what ``load`` reads (a table of a database), written there first."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    if load is None:
        raise RuntimeError(f"no snapshot at {path} and nothing to load it from")
    load().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def is_fresh(spark: SparkSession, paths: list[str], times: list[datetime], now: datetime) -> bool:
    """Whether the oldest of some snapshots isn't older than the results of the window before the current one.

    ``times``: when each window's results come out, in order. Always so without a window before; never if a snapshot is missing.
    """
    later = next((i for i, t in enumerate(times) if now < t), -1)
    if later <= 0:
        return True
    oldest = None
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(place):
            return False
        at = system.getFileStatus(place).getModificationTime() / 1000
        oldest = at if oldest is None else min(oldest, at)
    return oldest is None or oldest >= times[later - 1].timestamp()


def latest_folder(folders: DataFrame, name: str) -> str | None:
    """Of folders like 2025-26_T1_R1AW2 the one of the latest window: by round, its letter, window."""
    form = r"R(\d+)([ABCF]?)W(\d+)"
    letter = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in zip("ABCF", range(1, 5), strict=True) for x in kv]), F.regexp_extract(name, form, 2)), F.lit(0))
    key = F.struct(F.regexp_extract(name, form, 1).try_cast("int").alias("round"), letter.alias("letter"), F.regexp_extract(name, form, 3).try_cast("int").alias("window"))
    return folders.filter(F.col(name).rlike(form)).agg(F.max_by(name, key)).first()[0]


def pages(spark: SparkSession, term_folder: str) -> DataFrame:
    """The pages (filepath, html) of the latest window's folder of a term; none where there is no such folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(term_folder).select("path")
    folder = latest_folder(listed.select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct(), "folder")
    if folder is None:
        return spark.createDataFrame([], "filepath string, html string")
    rows = spark.read.text(f"{term_folder}/{folder}", wholetext=True, pathGlobFilter="*.html")
    return rows.select(F.col("_metadata.file_path").alias("filepath"), F.col("value").alias("html"))


def manifest(spark: SparkSession, folder: str, path: str) -> int:
    """Append the pages of a folder that the manifest at ``path`` doesn't list; returns how many."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(folder).select(F.col("path").alias("filepath"))
    try:
        found = unseen(found, spark.read.parquet(path), ["filepath"])
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    fresh = found.count()
    if fresh:
        found.write.mode("append").parquet(path)
    return fresh


def resume_points(paths: DataFrame, path: str) -> DataFrame:
    """Page files -> term, last: the largest class number of each folder."""
    number = F.regexp_extract(path, r"SelectedClassNumber=(\d+)\.html$", 1).try_cast("int")
    return paths.select(F.element_at(F.split(path, "/"), -2).alias("term"), number.alias("n")).filter("n > 0").groupBy("term").agg(F.max("n").alias("last"))
