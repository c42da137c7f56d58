"""Text expressions over tables of cases."""

import pytest
from pyspark.sql import functions as F

from seatloom.functions import student_t
from seatloom.functions import text as T


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_windows(spark):
    cases = {
        "Round 1 Window 1": ("1", 1), "Round 1F Window 1": ("1F", 1), "Rnd 1A Win 2": ("1A", 2), "Incoming Freshmen Rnd 1 Win 4": ("1F", 4), "round 2b window 3": ("2b", 3),
        "Incoming Exchange Rnd 1C Win 1": ("1C", 1), "Some 1A Window 5 text": ("1A", 5), "Some 2A text": ("2A", 1), "": None, "none": None, None: None,
    }
    got = values(spark, list(cases), lambda c: T.parse_window(c, generic=True))
    assert [tuple(g) if g else None for g in got] == list(cases.values())
    assert values(spark, ["Rnd 1A Win 2"], lambda c: T.parse_window(c, abbreviated=False)) == [None]
    assert values(spark, ["Incoming Freshmen Rnd 1 Win 4"], lambda c: T.abbreviation(T.parse_window(c))) == ["R1FW4"]


def test_courses_terms_slugs(spark):
    got = values(spark, ["mgmt715 ", "LAW_101", "COR-ABC12x", None], T.split_course)
    assert [(g.subject, g.number) for g in got] == [("MGMT", 715), ("LAW_101", 0), ("COR-ABC", 12), (None, 0)]
    assert values(spark, ["2025-26 Term 3A", "2025-26_T1", "x"], T.term_from_text) == ["AY202526T3A", "AY202526T1", None]
    assert values(spark, [1999, 2025], lambda y: T.term_id(y, F.lit("2")), "int") == ["AY199900T2", "AY202526T2"]
    assert values(spark, ["  Ada  Lovelace! ", "É"], T.slug) == ["ada-lovelace", ""]


def test_aliases(spark):
    got = values(spark, [None, "", "[]", '["A","B, C"]', '{A,"B, C"}', "Solo Name", "[broken"], T.aliases)
    assert got == [[], [], [], ["A", "B, C"], ["A", "B, C"], ["Solo Name"], []]


def test_dates_numbers(spark):
    assert values(spark, ["5-Jan-2025", "31-Foo-2020", None], T.date_text) == ["2025-01-05 00:00:00.000 +0800", None, None]
    assert values(spark, ["12", "3.7", "-1", "", None], T.whole_number) == [12, None, None, None, None]
    assert values(spark, ["TBA", " nan ", "", None, "x"], T.is_unset) == [True, True, True, True, False]
    assert values(spark, [0.5, 1.0], lambda p: F.round(T.entropy_confidence(F.array(p, 1 - p)), 6), "double") == [0.0, 1.0]


def test_student_t():
    # recovered from two published quantiles each, see SURVEY
    assert abs(student_t.ppf(0.9, 2.404606) - student_t.ppf(0.1, 2.404606) * -1) < 1e-9
    assert abs(student_t.ppf(0.975, 10) - 2.2281388) < 1e-5 and abs(student_t.ppf(0.95, 1) - 6.3137515) < 1e-4
    import numpy as np

    rng = np.random.default_rng(0)
    x = 3 + 2 * rng.standard_t(4, 20_000)
    df, loc, scale = student_t.fit(np.append(x, [np.inf, np.nan]))
    assert 3.4 < df < 4.7 and abs(loc - 3) < 0.08 and abs(scale - 2) < 0.1
    assert student_t.fit(np.zeros(5))[2] == 0.0


@pytest.mark.parametrize("p", [0.01, 0.25, 0.5, 0.9, 0.999])
def test_student_t_inverts(p):
    assert abs(student_t.cdf(student_t.ppf(p, 3.3), 3.3) - p) < 1e-9
