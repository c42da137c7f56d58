"""Text functions held against known values, case by case."""

import pytest
from pyspark.sql import functions as F

from seatloom.functions import names as NM
from seatloom.functions import text as T

CASES = {}


def golden(name, source, inputs, outputs, f):
    """Inputs by column and what comes of them; shorter lists start again."""
    CASES[name] = inputs, outputs, f


def fields(struct, *names):
    return {n: struct[n] for n in names}


PART, CUSTOMER = ("part", "p_partkey"), ("customer", "c_custkey")

golden(
    "header_parse", PART,
    {"text": ["MGMT715 — G1", "COR-COMM175 - SG2 Intro", "ACCT 101 — G3", "ACCT 101A - day 7", "A B G12 — x", "no header", None, "FIN203 — <i>Topic</i>", "LAW_101 -  Some G10 more"]},
    {"course_code": ("VARCHAR", ["MGMT715", "COR-COMM175", "ACCT101", "ACCT101A", "A B", None, None, "FIN203", "LAW_101"]), "section": ("VARCHAR", ["G1", "SG2", "G3", "7", "G12", None, None, None, "G10"])},
    lambda text: fields(T.parse_header(text), "course_code", "section"),
)
golden(
    "term_inference", PART,
    {
        "text": ["2025-26 Term 1", "2025-26 January Term", "2024-25 Term 3", "2024-25 Term 3", "2023-24 Special", "1998-99 Session 2", "nothing", "2025-26 Special", None],
        "folder": ["x", "x", "2024-25_T3B", "other", "2023-24_T3A", "", "2023-24_T1", "none", "2023-24_T1"],
    },
    {
        "year_start": ("INTEGER", [2025, 2025, 2024, 2024, 2023, 1998, None, 2025, None]), "year_end": ("INTEGER", [2026, 2026, 2025, 2025, 2024, 1999, None, 2026, None]),
        "term": ("VARCHAR", ["T1", "T2", "T3B", "T3", "T3A", "T2", None, None, None]),
        "acad_term_id": ("VARCHAR", ["AY202526T1", "AY202526T2", "AY202425T3B", "AY202425T3", "AY202324T3A", "AY199899T2", None, None, None]),
    },
    lambda text, folder: fields(T.parse_term(text, folder), "year_start", "year_end", "term", "acad_term_id"),
)
golden(
    "mojibake_clean", PART,
    {"text": ["Itâ€™s", "aâ€¦b", "â€¢ x Â", 'aâ€"b', "é ü stay", None, "so-calledâ€ ", "plain"]},
    {"cleaned": ("VARCHAR", ["It's", "a…b", "• x", "a—b", "é ü stay", None, 'so-called"', "plain"])},
    lambda text: {"cleaned": T.repair_encoding(text)},
)
golden(
    "cell_clean", CUSTOMER, {"text": ["  a   b ", "", "-", None, "12.5", "   ", "x&nbsp;y"]},
    {"cell": ("VARCHAR", ["a b", "-", "-", "None", "12.5", "-", "x y"]), "bid": ("VARCHAR", ["a b", "0", "0", "None", "12.5", "0", "x y"])},
    lambda text: {"cell": T.clean_cell(text), "bid": T.clean_cell(text, bid=True)},
)
golden(
    "html_pieces", CUSTOMER,
    {"html": ["<ul><li>A</li><li class=x> B </li></ul>", "none", "<li>One</li>", None], "script": ["window.open('http://u/x','w')", "open()", None, "a;window.open('/p')"]},
    {"items": ("VARCHAR", ["A, B", None, "One", None]), "url": ("VARCHAR", ["http://u/x", None, None, "/p"])},
    lambda html, script: {"items": T.list_items(html), "url": T.opened_url(script)},
)
golden(
    "file_names", CUSTOMER,
    {
        "path": ["/d/2025-26_T1/SelectedAcadTerm=253&SelectedClassNumber=1001.html", "SelectedAcadTerm=253A&SelectedClassNumber=x.html", "/SelectedClassNumber=7/page.html", None],
        "source": ["data_AY202526T3A_v2", "AY202425T1.csv", "none", None],
    },
    {"acad_term_boss_id": ("INTEGER", [253, 253, None, None]), "class_boss_id": ("INTEGER", [1001, None, None, None]), "term": ("VARCHAR", ["AY202526T3A", "AY202425T1", None, None])},
    lambda path, source: {**fields(T.file_ids(path), "acad_term_boss_id", "class_boss_id"), "term": T.source_term(source)},
)
golden(
    "legacy_features", CUSTOMER,
    {
        "text": ["Round 1A Window 2", "Incoming Freshmen Rnd 1 Win 4", "Incoming Exchange Rnd 1C Win 3", "Round 2A", None],
        "code": ["MGMT715", "COR-A12x", "LAW5", "12", None],
    },
    {
        "round": ("VARCHAR", ["1A", "1", "1C", "2A", None]), "window": ("INTEGER", [2, 4, 3, -1, -1]), "freshmen": ("BOOLEAN", [False, True, False, False, False]),
        "exchange": ("BOOLEAN", [False, False, True, False, False]), "subject": ("VARCHAR", ["MGMT", "COR-A", "LAW", None, None]), "number": ("VARCHAR", ["715", None, "5", "12", None]),
        "difficulty": ("INTEGER", [7, 0, 0, 1, 0]), "topic": ("INTEGER", [15, 0, 0, 2, 0]),
    },
    lambda text, code: {**fields(T.legacy_window(text), "round", "window", "freshmen", "exchange"), **fields(T.legacy_course(code), "subject", "number", "difficulty", "topic")},
)
GIVEN = ("JOHN", "AMY", "WARREN")
golden(
    "name_normaliser", CUSTOMER,
    {
        "name": ["john smith", "AMY TAN", "TAN AMY", "Warren B. Chik", "LEE, Pui Yee", "Ahmad bin Ismail", "Ludwig van Beethoven", "Plato", None, "Q (visiting)", "zoe amy kim"],
        "surname": ["SMITH", "Tan", "tan", "Chik", "Pui", "zz", "VAN", "plato", "X", "q", "kim"],
    },
    {
        "boss_name": ("VARCHAR", ["JOHN SMITH", "AMY TAN", "TAN AMY", "WARREN CHIK", "LEE, PUI YEE", "AHMAD BIN ISMAIL", "LUDWIG VAN BEETHOVEN", "PLATO", "UNKNOWN", "", "ZOE AMY KIM"]),
        "display_name": ("VARCHAR", ["John SMITH", "Amy TAN", "TAN Amy", "Warren CHIK", "LEE Pui Yee", "Ahmad bin ISMAIL", "Ludwig VAN BEETHOVEN", "Plato", "Unknown", "Unknown", "ZOE Amy Kim"]),
        "shown": ("VARCHAR", ["John SMITH", "Amy TAN", "TAN Amy", "Warren B. CHIK", "Lee, PUI Yee", "Ahmad Bin Ismail", "Ludwig VAN Beethoven", "PLATO", None, "Q (visiting)", "Zoe Amy KIM"]),
    },
    lambda name, surname: {**fields(NM.normalise(name, GIVEN), "boss_name", "display_name"), "shown": NM.with_surname(name, surname)},
)
golden(
    "name_patterns", CUSTOMER,
    {"a": ["John Tan", "Tan Wei", "Tan John", None, "Foo Bar", "  "], "b": ["Tan, John Lee", "WEI Tan", "Tan", "x", "Bar", None]},
    {"pattern": ("VARCHAR", ["WESTERN", "ASIAN", "WESTERN", "UNKNOWN", "WESTERN", "UNKNOWN"]), "alike": ("BOOLEAN", [True, False, True, True, True, True])},
    lambda a, b: {"pattern": NM.pattern(a, GIVEN), "alike": NM.names_match(a, b)},
)
golden(
    "fuzzy_score", CUSTOMER,
    {"a": ["WARREN CHIK", "RACHEL TAN YEN JUN", "KAM WAI CHIK", "ABCD", None, "John, Doe"], "b": ["Kam Wai Warren Chik", "TAN RACHEL", "KAM WAI WARREN CHIK", "ABXD", "x", "john doe"]},
    {"score": ("INTEGER", [95, 100, 100, 75, 0, 95])},
    lambda a, b: {"score": NM.fuzzy_score(a, b)},
)
golden(
    "natural_keys", CUSTOMER, {"text": ["G10", "A2b10", "x", None, "7", "G9"]},
    {"key": ("VARCHAR", ["g|10", "a|2,b|10", "x|-1", None, "|7", "g|9"])},
    lambda text: {"key": F.when(text.isNotNull(), F.array_join(F.transform(T.natural_key(text), lambda p: F.concat_ws("|", p["t"], p["n"].cast("string"))), ","))},
)
golden(
    "safe_numbers", CUSTOMER,
    {"text": ["3.7", "-5", " 12 ", "x", None, "1e2", "nan", ""], "id": ["A987FBC9-4BED-4078-8F07-9141BA07C9F3", "a987fbc9-4bed-6078-8f07-9141ba07c9f3", "a987fbc9", None, "", " a987fbc9-4bed-1078-bf07-9141ba07c9f3 ", "x", "y"]},
    {
        "whole": ("INTEGER", [None, -5, 12, None, None, None, None, None]), "number": ("DOUBLE", [3.7, -5.0, 12.0, None, None, 100.0, None, None]),
        "uuid": ("BOOLEAN", [True, False, False, False, False, True, False, False]),
    },
    lambda text, id: {"whole": T.safe_int(text), "number": T.safe_float(text), "uuid": T.is_uuid(id)},
)
golden(
    "academic_years", CUSTOMER, {"first": ["2025-26_T1", "1999-00_T1", "2026-27_T1"], "last": ["2028-29_T2", "1999-00_T2", "2025-26_T1"]},
    {"years": ("VARCHAR", ["2025-26,2026-27,2027-28,2028-29", "1999-00", ""])},
    lambda first, last: {"years": F.array_join(T.year_range(first, last), ",")},
)
golden(
    "window_hierarchy", CUSTOMER,
    {
        "term": ["AY202425T3A", "AY202324T1", "AY202425T1", "AY202526T2", "AY202526T1", "bad"], "round": ["1", "1A", "1A", "1F", "1", "1"], "window": [4, 2, 3, 4, 2, 1],
        "folder": ["2025-26_T1_R1AW1", "R2W1", "2025-26_T1_R1W1", "x_R1FW1", "none", None], "date": ["2024-05-07", "bad", None, "2024-02-30", "2024-12-31", "2024-1-1"],
    },
    {
        "place": ("INTEGER", [4, 4, 4, 19, None, None]), "before_round": ("VARCHAR", ["1", "1F", None, "1C", None, None]), "before_window": ("INTEGER", [1, 4, None, 3, None, None]),
        "day": ("INTEGER", [7, 0, 0, 0, 31, 0]), "month": ("INTEGER", [5, 0, 0, 0, 12, 0]),
    },
    lambda term, round, window, folder, date: {
        "place": T.window_place(term, round, window), "before_round": T.window_before(folder)["round"], "before_window": T.window_before(folder)["window"], **fields(T.date_parts(date), "day", "month"),
    },
)


@pytest.mark.parametrize("name", sorted(CASES))
def test_cases(spark, name):
    inputs, outputs, f = CASES[name]
    n = max(map(len, (*inputs.values(), *(v for _, v in outputs.values()))))
    schema = ", ".join(f"`{c}` {'int' if any(isinstance(x, int) for x in v) else 'string'}" for c, v in inputs.items())
    rows = spark.createDataFrame([(i, *(v[i % len(v)] for v in inputs.values())) for i in range(n)], "case_no int, " + schema)
    got = rows.select("case_no", *[c.alias(k) for k, c in f(**{c: F.col(c) for c in inputs}).items()]).orderBy("case_no").collect()
    for i, r in enumerate(got):
        assert {k: r[k] for k in outputs} == {k: v[i % len(v)] for k, (_, v) in outputs.items()}


def test_names_by_every_rule(spark, sf_dir):
    """The query on parts' names meets a father's name, a particle, known names, brackets and no name, not only the plain rules."""
    from seatloom.plans import catalog

    r = {x.p_partkey: x for x in catalog.QUERIES["name_normaliser"](spark, sf_dir).collect()}
    shown = lambda k: [x.display_name for key, x in r.items() if key % 10 == k]
    assert all(" bin " in d for d in shown(4)) and all(" VAN " in d for d in shown(5)) and all(d.startswith("TAN ") for d in shown(6))
    assert all(d.startswith("John TAN ") for d in shown(7)) and all(" Amy " in d for d in shown(8)) and "Unknown" in shown(9) and len(r) == spark.read.parquet(f"{sf_dir}/part.parquet").count()


def test_terms_are_worked_out_once(spark, sf_dir):
    """A text is repaired once a row, not once for each of the fields that are read from it."""
    from seatloom.plans import catalog

    plan = catalog.QUERIES["term_inference"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") <= 6 and plan.count("regexp_replace(") == 1
