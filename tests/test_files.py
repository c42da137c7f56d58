"""Readers and sinks in small: missing and bad files, contracts, appends, upserts, partitions written once."""

import datetime

from seatloom.sources import files, sinks, versions


def test_csv_tolerates(spark, tmp_path):
    schema = "code string, seats int"
    assert files.read_csv(spark, str(tmp_path / "none"), schema, ["code"]).count() == 0
    (tmp_path / "a.csv").write_text("code,seats,more\nX1,3,q\nX2,bad,q\n")
    assert files.read_csv(spark, str(tmp_path / "a.csv"), schema, ["code"]).collect() == [("X1", 3), ("X2", None)]
    assert files.read_csv(spark, str(tmp_path / "a.csv"), schema, ["term"]).count() == 0
    (tmp_path / "b.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path / "b.csv"), schema, ["code"]).count() == 0


def test_csv_contract(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"], datetime.datetime(2025, 1, 2, 3, 4, 5), "x")], "id int, names array<string>, at timestamp, other string")
    assert not sinks.write_csv(rows.limit(0), str(tmp_path / "c"), ["id"])
    assert sinks.write_csv(rows, str(tmp_path / "c"), ["names", "id", "at"])
    back = spark.read.csv(str(tmp_path / "c"), header=True, escape='"')
    assert back.columns == ["names", "id", "at"] and back.first()["at"].startswith("2025-01-02T03:04:05")


def test_append_upsert_once(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    sinks.append_new(one, at("t"), ["id"])
    sinks.append_new(two, at("t"), ["id"])
    assert sorted(spark.read.parquet(at("t")).collect()) == [(1, "a"), (2, "b"), (3, "d")]
    sinks.upsert(at("t"), two, ["id"], at("t2"))
    assert sorted(spark.read.parquet(at("t2")).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sinks.write_once(one, at("p"), "term", "T1") and not sinks.write_once(two, at("p"), "term", "T1")
    assert spark.read.parquet(at("p")).filter("term = 'T1'").count() == 3


def xlsx(path, sheets):
    """A workbook of text cells, some shared, some inline, and numbers."""
    import zipfile

    shared, parts = [], {}
    for n, rows in enumerate(sheets.values(), 1):
        xml = ""
        for i, row in enumerate(rows, 1):
            cells = ""
            for j, v in enumerate(row):
                at = f"{chr(65 + j)}{i}"
                if isinstance(v, int):
                    cells += f'<c r="{at}"><v>{v}</v></c>'
                elif v is not None and j % 2:
                    cells += f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
                elif v is not None:
                    shared.append(v)
                    cells += f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
            xml += f'<row r="{i}">{cells}</row>'
        parts[f"xl/worksheets/sheet{n}.xml"] = f'<worksheet xmlns="m"><sheetData>{xml}</sheetData></worksheet>'
    names = "".join(f'<sheet name="{s}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="m" xmlns:r="rel"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = "<R>" + "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1)) + "</R>"
    parts["xl/sharedStrings.xml"] = "<sst>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>"
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)


def test_workbooks(spark, tmp_path):
    xlsx(tmp_path / "a.xlsx", {"standalone": [["code", "seats"], ["X1", 3], [None, 4]], "multiple": [["key", "day"], ["k", "Mon"]]})
    (tmp_path / "bad.xlsx").write_text("no workbook")
    rows = files.workbook(spark, str(tmp_path), "standalone").orderBy("row").collect()
    assert [(r.source_file, r.row, r.cells) for r in rows] == [("a.xlsx", 0, {"code": "X1", "seats": "3"}), ("a.xlsx", 1, {"code": None, "seats": "4"})]
    assert [r.cells for r in files.workbook(spark, str(tmp_path), "multiple").collect()] == [{"key": "k", "day": "Mon"}]
    assert files.workbook(spark, str(tmp_path / "none")).count() == 0 and files.workbook(spark, str(tmp_path), "other").count() == 0


def test_folders_snapshots_manifests(spark, tmp_path):
    import os

    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "c" / "b.csv").write_text("y,z\n3,4\n")
    (tmp_path / "c" / "empty.csv").write_text("")
    got = files.csv_folder(spark, str(tmp_path / "c"))
    assert sorted((r.source_file, r.x, r.y, r.z) for r in got.collect()) == [("a.csv", "1", "2", None), ("b.csv", None, "3", "4")]
    path, loads = str(tmp_path / "snap"), []
    load = lambda: loads.append(1) or spark.range(3)
    assert files.snapshot(spark, path, load).count() == 3 and files.snapshot(spark, path, load).count() == 3 and loads == [1]
    try:
        files.snapshot(spark, str(tmp_path / "gone"))
        raise AssertionError("a snapshot from nothing")
    except RuntimeError:
        pass
    at = datetime.datetime
    times = [at(2020, 1, 1), at(2021, 1, 1), at(2100, 1, 1)]
    assert files.is_fresh(spark, [path], times, at(2022, 1, 1)) and files.is_fresh(spark, [], [], at(2022, 1, 1)) and not files.is_fresh(spark, [path, str(tmp_path / "gone")], times, at(2022, 1, 1))
    os.utime(path, (1, 1))
    assert not files.is_fresh(spark, [path], times, at(2022, 1, 1)) and files.is_fresh(spark, [path], times, at(2019, 1, 1))
    for folder, n in (("T1_R1W1", 5), ("T1_R1FW2", 7), ("T1_R1AW3", 6)):
        (tmp_path / "p" / folder).mkdir(parents=True)
        for k in (1, n):
            (tmp_path / "p" / folder / f"SelectedAcadTerm=1&SelectedClassNumber={k}.html").write_text(f"<p>{folder} {k}\nline</p>")
    assert sorted(r.html for r in files.pages(spark, str(tmp_path / "p")).collect()) == ["<p>T1_R1FW2 1\nline</p>", "<p>T1_R1FW2 7\nline</p>"]
    listed = str(tmp_path / "manifest")
    assert files.manifest(spark, str(tmp_path / "p"), listed) == 6 and files.manifest(spark, str(tmp_path / "p"), listed) == 0
    (tmp_path / "p" / "T1_R1W1" / "more.html").write_text("x")
    assert files.manifest(spark, str(tmp_path / "p"), listed) == 1
    assert {r.term: r["last"] for r in files.resume_points(spark.read.parquet(listed), "filepath").collect()} == {"T1_R1W1": 5, "T1_R1FW2": 7, "T1_R1AW3": 6}


def test_null_keys_and_sheets(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    rows = spark.createDataFrame([(1, None), (1, "a"), (1, None)], "id int, v string")
    for _ in range(2):
        sinks.append_new(rows, at("t"), ["id", "v"])
    assert sorted(spark.read.parquet(at("t")).collect(), key=str) == sorted([(1, "a")] + [(1, None)] * 4, key=str)
    s = spark.createDataFrame([("T", "c", "g", "w")], "acad_term_id string, course_code string, section string, bidding_window string")
    m = lambda rows: spark.createDataFrame(rows, "record_key string, day string")
    e = spark.createDataFrame([("f", "bad")], "filepath string, error string")
    sinks.merge_sheets(s, m([("r1", "Mon"), ("r1", "Tue"), ("r2", "Wed")]), e, at("book"), "v1")
    sinks.merge_sheets(s, m([("r1", "Tue"), ("r1", "Mon"), ("r2", "Fri"), ("r3", "Sat")]), e, at("book"), "v2")
    log = versions.Versions(spark, at("book"))
    assert log.read("standalone").count() == 1 and log.read("errors").count() == 2
    assert log.read("multiple").filter("_version = 2").count() == 2
    assert sorted(map(tuple, sinks.read_multiple(spark, at("book")).select("record_key", "day").collect())) == [("r1", "Mon"), ("r1", "Tue"), ("r2", "Fri"), ("r3", "Sat")]
