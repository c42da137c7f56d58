"""Workbooks (.xlsx) as a data source of Spark: ``spark.read.format("workbook")`` and ``df.write.format("workbook")``.

Reading: a partition is a range of rows of one sheet. Sheets are streamed: rows before a range are passed over unparsed, so memory is that of one batch and
the book's shared texts. Writing: each task writes the rows of its sheets to parts beside the target; the commit streams the parts, in the order of
partitions, into one book and moves it to its name; an abort deletes the parts, so a job that fails leaves nothing. The last step runs on the driver, for a book is one
file; it streams, and a sheet has at most 1,048,576 rows by format.

Paths are opened by Arrow's file systems (local, hdfs, s3, gs), which executors and driver must reach. Missing paths and files that are no workbooks give no rows.
"""

from __future__ import annotations

import html
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from seatloom.runtime import ship

CELLS = "source_file string, row long, cells map<string,string>"
#: Fixed by the format.
MOST_ROWS = 1_048_576
BATCH, CHUNK = 10_000, 1 << 20
_CELL = re.compile(rb"<(?:\w+:)?c\b([^>]*?)(?:/>|>(.*?)</(?:\w+:)?c>)", re.S)
_PLACE, _KIND = re.compile(rb'\br="([A-Z]+)\d*"'), re.compile(rb'\bt="(\w+)"')
_VALUE, _TEXT = re.compile(rb"<(?:\w+:)?v\b[^>]*>(.*?)</(?:\w+:)?v>", re.S), re.compile(rb"<(?:\w+:)?t\b[^>]*>(.*?)</(?:\w+:)?t>", re.S)
_SOUND = re.compile(rb"<(?:\w+:)?rPh\b.*?</(?:\w+:)?rPh>", re.S)
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))


def fragments(stream, tag: bytes, skip: int = 0) -> Iterator[bytes]:
    """The pieces of a stream that begin with a tag, after ``skip`` of them; the last has what follows it."""
    start, held, last = re.compile(rb"<(?:\w+:)?" + tag + rb"(?=[\s>/])"), b"", False
    while not last:
        chunk = stream.read(CHUNK)
        last = not chunk
        held += chunk
        at = [m.start() for m in start.finditer(held)]
        whole = at if last else at[:-1]
        ends = [*at[1:], len(held)]
        for a, b in zip(whole, ends, strict=False):
            if skip:
                skip -= 1
            else:
                yield held[a:b]
        # what is not whole yet, or a tag cut in two
        held = held[at[-1] :] if at else held[-64:]


def shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return [html.unescape(b"".join(_TEXT.findall(_SOUND.sub(b"", si))).decode()) for si in fragments(stream, b"si")]


def sheets_of(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names of the sheets in order, and their parts of the file."""
    attribute = lambda tag, name: next((html.unescape(v.decode()) for v in re.findall(rb"[\s:]" + name + rb'\s*=\s*"([^"]*)"', tag)), "")
    links = {attribute(t, b"Id"): attribute(t, b"Target") for t in re.findall(rb"<(?:\w+:)?Relationship\b[^>]*>", book.read("xl/_rels/workbook.xml.rels"))}
    found = re.findall(rb"<(?:\w+:)?sheet\b[^>]*>", book.read("xl/workbook.xml"))
    return [(attribute(t, b"name"), "xl/" + links.get(attribute(t, b"id"), "").removeprefix("/xl/").removeprefix("/")) for t in found]


def values_of(row: bytes, shared: list[str]) -> list[str | None]:
    """The cells of a row by place; null where there is none."""
    out: list[str | None] = []
    for attributes, inner in _CELL.findall(row):
        at = len(out)
        if place := _PLACE.search(attributes):
            at = reduce(lambda n, letter: n * 26 + letter - 64, place[1], 0) - 1
        kind, value = _KIND.search(attributes), None
        if kind and kind[1] == b"inlineStr":
            value = html.unescape(b"".join(_TEXT.findall(inner)).decode())
        elif found := _VALUE.search(inner):
            value = html.unescape(found[1].decode())
            value = shared[int(value)] if kind and kind[1] == b"s" else value
        out += [None] * (at + 1 - len(out))
        out[at] = value
    return out


def header_of(row: bytes, shared: list[str]) -> list[str]:
    return [h or f"column_{i}" for i, h in enumerate(values_of(row, shared))]


@dataclass
class Rows(InputPartition):
    """Rows ``start`` to ``stop`` (below the header; to the end if null) of a sheet."""

    path: str
    part: str
    start: int
    stop: int | None


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.sheet = schema, options["path"], options.get("sheet")
        self.rows = int(options.get("rowsPerPartition", 100_000))

    def partitions(self) -> list[Rows]:
        files, root = opened(self.path)
        told = files.get_file_info(root)
        books = [told] if told.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        out = []
        for book in sorted((b.path for b in books if b.type == fs.FileType.File and b.path.endswith(".xlsx"))):
            try:
                with files.open_input_file(book) as stream, zipfile.ZipFile(stream) as z:
                    part = next((p for name, p in sheets_of(z) if self.sheet is None or name == self.sheet), None)
                    if part not in z.namelist():
                        continue
                    with z.open(part) as sheet:
                        size = re.search(rb'<(?:\w+:)?dimension\b[^>]*ref="[A-Z0-9]*:[A-Z]+(\d+)"', sheet.read(4096))
            except (zipfile.BadZipFile, KeyError, pa.ArrowInvalid):
                continue
            # the size that the sheet states only tells where to cut: the last range is open
            starts = [*range(0, max(1, int(size[1]) - 1 if size else 1), self.rows)]
            out += [Rows(book, part, a, b) for a, b in zip(starts, [*starts[1:], None], strict=True)]
        return out

    def read(self, partition: Rows | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        files, _ = opened(self.path)
        with files.open_input_file(partition.path) as stream, zipfile.ZipFile(stream) as z:
            shared = shared_texts(z)
            with z.open(partition.part) as sheet:
                head = next((header_of(r, shared) for r in fragments(sheet, b"row")), [])
            with z.open(partition.part) as sheet:
                held, at = [], partition.start
                for row in fragments(sheet, b"row", partition.start + 1):
                    if at == partition.stop:
                        break
                    held.append((at, values_of(row, shared)))
                    at += 1
                    if len(held) == BATCH:
                        yield self.batch(partition.path, head, held)
                        held = []
                if held:
                    yield self.batch(partition.path, head, held)

    def batch(self, path: str, head: list[str], rows: list[tuple[int, list[str | None]]]) -> pa.RecordBatch:
        name, place = path.rpartition("/")[2], {h: i for i, h in reversed(list(enumerate(head)))}
        columns = []
        for f in self.schema.fields:
            if f.name == "source_file":
                columns.append(pa.array([name] * len(rows), pa.string()))
            elif f.name == "row" and f.name not in place:
                told = pa.array([n for n, _ in rows], pa.int64())
                columns.append(told.cast(pa.string()) if isinstance(f.dataType, StringType) else told)
            elif f.name == "cells" and f.name not in place:
                columns.append(pa.array([list(dict(zip(head, v, strict=False)).items()) for _, v in rows], pa.map_(pa.string(), pa.string())))
            else:
                i = place.get(f.name)
                columns.append(pa.array([v[i] if i is not None and i < len(v) else None for _, v in rows], pa.string()))
        return pa.RecordBatch.from_arrays(columns, [f.name for f in self.schema.fields])


@dataclass
class Parts(WriterCommitMessage):
    """What a task has written: sheet -> file and number of rows."""

    partition: int
    files: dict[str, tuple[str, int]]


class WorkbookWriter(DataSourceArrowWriter):
    """Rows (sheet, cells) into one book."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.sheets = options["path"], json.loads(options["sheets"])
        files, path = opened(self.path)
        if not overwrite and files.get_file_info(path).type != fs.FileType.NotFound:
            raise FileExistsError(self.path)
        self.parts = f"{path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        context = TaskContext.get()
        files, _ = opened(self.path)
        files.create_dir(self.parts)
        streams, counts, names = {}, {}, {}
        for batch in iterator:
            for sheet, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if sheet not in streams:
                    names[sheet] = f"{self.parts}/{context.taskAttemptId()}-{list(self.sheets).index(sheet)}"
                    streams[sheet], counts[sheet] = files.open_output_stream(names[sheet], compression="gzip"), 0
                streams[sheet].write(row_xml(cells, self.sheets[sheet]))
                counts[sheet] += 1
        for stream in streams.values():
            stream.close()
        return Parts(context.partitionId(), {s: (names[s], counts[s]) for s in names})

    def commit(self, messages: list[Parts | None]) -> None:
        files, path = opened(self.path)
        parts = sorted((m for m in messages if m), key=lambda m: m.partition)
        for sheet in self.sheets:
            if sum(m.files.get(sheet, ("", 0))[1] for m in parts) + 1 > MOST_ROWS:
                raise ValueError(f"more than {MOST_ROWS} rows in sheet {sheet}")
        files.create_dir(self.parts)
        draft = f"{self.parts}/book"
        with files.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in frame(list(self.sheets)).items():
                z.writestr(name, text)
            for n, (sheet, columns) in enumerate(self.sheets.items(), 1):
                with z.open(f"xl/worksheets/sheet{n}.xml", "w", force_zip64=True) as target:
                    rows = 1 + sum(m.files.get(sheet, ("", 0))[1] for m in parts)
                    target.write(f'{XML}<worksheet xmlns="{MAIN}"><dimension ref="A1:{letters(max(len(columns), 1))}{rows}"/><sheetData>'.encode())
                    target.write(row_xml([c for c, _ in columns], [(c, False) for c, _ in columns]))
                    for file in (m.files[sheet][0] for m in parts if sheet in m.files):
                        with files.open_input_stream(file, compression="gzip") as source:
                            while piece := source.read(CHUNK):
                                target.write(piece)
                    target.write(b"</sheetData></worksheet>")
        files.move(draft, path)
        files.delete_dir(self.parts)

    def abort(self, messages: list[Parts | None]) -> None:
        files, _ = opened(self.path)
        if files.get_file_info(self.parts).type != fs.FileType.NotFound:
            files.delete_dir(self.parts)


#: Fixed by the format.
XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
MAIN, LINKS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE, KINDS = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"


def frame(sheets: list[str]) -> dict[str, str]:
    """The parts of a book besides its sheets."""
    each = list(enumerate(sheets, 1))
    types = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{KINDS}.worksheet+xml"/>' for n, _ in each)
    named = "".join(f'<sheet name={quoteattr(s)} sheetId="{n}" r:id="rId{n}"/>' for n, s in each)
    links = "".join(f'<Relationship Id="rId{n}" Type="{LINKS}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n, _ in each)
    return {
        "[Content_Types].xml": f'{XML}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{KINDS}.sheet.main+xml"/>{types}</Types>',
        "_rels/.rels": f'{XML}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{XML}<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{named}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{XML}<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>',
    }


def letters(n: int) -> str:
    """Letters of the n-th column."""
    return (letters((n - 1) // 26) if n > 26 else "") + chr(65 + (n - 1) % 26)


def row_xml(cells: list[str | None], columns: list[tuple[str, bool]]) -> bytes:
    out = []
    for value, (_, number) in zip(cells, columns, strict=True):
        if value is None:
            out.append("<c/>")
        elif number:
            out.append(f"<c><v>{value}</v></c>")
        else:
            out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_CONTROL.sub("", value))}</t></is></c>')
    return f"<row>{''.join(out)}</row>".encode()


class Workbook(DataSource):
    """Options for reading: path (a book or a folder), sheet (the first if left out), rowsPerPartition; a schema of texts picks columns by header."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Workbook)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, schema: str | None = None, rows: int = 100_000) -> DataFrame:
    """A sheet of a book, or of each book of a folder: source_file, row, cells; or the columns of ``schema``, values that don't fit being null."""
    register(spark)
    reader = spark.read.format("workbook").option("rowsPerPartition", rows)
    reader = reader if sheet is None else reader.option("sheet", sheet)
    if schema is None:
        return reader.load(path)
    wanted = spark.createDataFrame([], schema).schema
    texts = reader.schema(StructType([type(f)(f.name, StringType()) for f in wanted])).load(path)
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def write_book(sheets: dict[str, DataFrame], path: str, overwrite: bool = True) -> None:
    """Several sheets as one book, in one job: it is there with all of them, or not at all. Lists and structs are written as JSON."""
    spark = next(iter(sheets.values())).sparkSession
    register(spark)
    told, parts = {}, []
    for name, df in sheets.items():
        told[name] = [(f.name, isinstance(f.dataType, NumericType)) for f in df.schema.fields]
        shown = [F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, (NumericType, BooleanType, StringType)) or f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else F.to_json(f"`{f.name}`") for f in df.schema.fields]
        parts.append(df.select(F.lit(name).alias("sheet"), F.array(*shown).cast("array<string>").alias("cells")))
    rows = reduce(DataFrame.unionByName, parts)
    rows.write.format("workbook").option("sheets", json.dumps(told)).mode("overwrite" if overwrite else "append").save(path)
