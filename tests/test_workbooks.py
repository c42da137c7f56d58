"""Workbooks as a data source: what is written is read, ranges, aborts, long sheets."""

import io
import os
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from seatloom.sources import files, workbooks


def sheets(spark):
    odd = ["a & b <c>", ' "quoted" ', "line\nbreak", "", None, "é\u0001x", "=1+1"]
    return {
        "standalone": spark.createDataFrame([(i, t, i / 4, i % 2 == 0, ["x", t]) for i, t in enumerate(odd)], "n int, text string, share double, even boolean, list array<string>").repartition(3),
        "multiple": spark.range(2500).select(F.col("id"), F.concat(F.lit("k"), F.col("id")).alias("key")),
        "errors & more": spark.createDataFrame([], "file string"),
    }


def test_three_sheets(spark, tmp_path):
    path, three = str(tmp_path / "book.xlsx"), sheets(spark)
    workbooks.write_book(three, path)
    got = workbooks.read_sheet(spark, path, "standalone", "n int, text string, share double, even boolean, list string, none string").orderBy("n").collect()
    assert [(r.n, r.text, r.share, r.even, r.none) for r in got] == [(r.n, r.text and r.text.replace("\u0001", ""), r.share, r.even, None) for r in three["standalone"].orderBy("n").collect()]
    assert got[1].list == '["x"," \\"quoted\\" "]'
    rows = workbooks.read_sheet(spark, path, "multiple", rows=400)
    assert rows.rdd.getNumPartitions() == 7
    assert [(r.row, r.cells["id"]) for r in rows.orderBy("row").collect()] == [(i, str(i)) for i in range(2500)]
    assert {r.source_file for r in rows.collect()} == {"book.xlsx"}
    assert workbooks.read_sheet(spark, path, "errors & more").count() == 0 and workbooks.read_sheet(spark, path, "other").count() == 0
    assert workbooks.read_sheet(spark, path).count() == 7  # the first sheet
    assert files.workbook(spark, str(tmp_path), "multiple").count() == 2500
    assert os.listdir(tmp_path) == ["book.xlsx"] or sorted(os.listdir(tmp_path)) == [".book.xlsx.crc", "book.xlsx"]


def test_failed_write_leaves_what_was(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        workbooks.write_book({"a": broken}, path)
    assert os.listdir(tmp_path) == []
    workbooks.write_book({"a": spark.range(3)}, path)
    with pytest.raises(Exception, match="lost"):
        workbooks.write_book({"a": broken}, path)
    with pytest.raises(Exception, match="FileExistsError"):
        workbooks.write_book({"a": spark.range(9)}, path, overwrite=False)
    assert os.listdir(tmp_path) == ["book.xlsx"] and workbooks.read_sheet(spark, path, "a").count() == 3


def test_odd_paths(spark, tmp_path):
    (tmp_path / "bad.xlsx").write_text("no workbook")
    assert workbooks.read_sheet(spark, str(tmp_path)).count() == 0 and workbooks.read_sheet(spark, str(tmp_path / "none")).count() == 0


def test_a_million_rows_stream(tmp_path):
    """Fragments of a long sheet take no more memory than a few chunks."""
    path = tmp_path / "long.xlsx"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("s", "w") as out:
        for i in range(100):
            out.write(b"".join(b'<row r="%d"><c r="A1"><v>%d</v></c><c t="inlineStr"><is><t>word word</t></is></c></row>' % (n, n) for n in range(i * 10_000, (i + 1) * 10_000)))
    tracemalloc.start()
    with zipfile.ZipFile(path) as z, z.open("s") as stream:
        n = sum(1 for _ in workbooks.fragments(stream, b"row", 5))
    with zipfile.ZipFile(path) as z, z.open("s") as stream:
        far = next(iter(workbooks.fragments(stream, b"row", 900_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 999_995 and workbooks.values_of(far, []) == ["900000", "word word"] and peak < 30_000_000


def test_fragments_across_chunks(monkeypatch):
    text = b"<sheetData>" + b"".join(b"<row><c><v>%d</v></c></row>" % i for i in range(50)) + b"</sheetData>"
    for size in (1, 2, 7, 64, 1000):
        monkeypatch.setattr(workbooks, "CHUNK", size)
        got = [workbooks.values_of(r, []) for r in workbooks.fragments(io.BytesIO(text), b"row", 3)]
        assert got == [[str(i)] for i in range(3, 50)]
