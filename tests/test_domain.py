"""The domain's functions on small tables: reading pages, people, classes, features, multipliers, the whole run."""

import math
import random
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatloom.domain import dims, facts, features, market, pages, safety, schemas
from seatloom.functions import names as NM
from seatloom.functions import student_t
from seatloom.operators import names as N
from seatloom.operators import tables

T1 = "AY202526T1"


def test_likeness_of_names():
    def common(a, b):
        if not a or not b:
            return 0
        return common(a[1:], b[1:]) + 1 if a[0] == b[0] else max(common(a[1:], b), common(a, b[1:]))

    for a, b in [("abcde", "xbxdx"), ("", "a"), ("kitten", "sitting"), ("aab", "aba"), ("abab", "baba")]:
        assert NM._common(a, b) == common(a, b)
    assert NM.likeness("ABCD", "ABXD") == 75 and NM.likeness("Tan Ann", "ann tan") == 100 and NM.likeness("", "x") == 0


def test_resolution_chain(spark):
    people = spark.createDataFrame([("p1", "LEE, ANN"), ("p2", "KAM WAI WARREN CHIK"), ("gone", "OLD NAME"), ("p3", "TAN WEI, MING")], "id string, alias string")
    session = spark.createDataFrame([("n1", "NEW ONE"), ("n1", "OLD NAME")], "id string, alias string")
    valid = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "id string")
    asked = ["Lee Ann", "warren chik", "Old Name", "New  One", "tan wei ming", "TBA", "Chik", None]
    rows = spark.createDataFrame(list(enumerate(asked)), "k int, name string")
    got = {r.k: (r.id, r.strategy) for r in N.resolve(rows, "k", "name", people, "id", "alias", session, valid).collect()}
    assert got == {0: ("p1", 4), 1: ("p2", 6), 2: ("n1", 7), 3: ("n1", 9), 4: ("p3", 5), 5: (None, None), 6: (None, None), 7: (None, None)}


def test_as_of_of_a_long_schedule(spark):
    import datetime as d

    at = lambda h: d.datetime(2025, 1, 1) + d.timedelta(hours=h)
    s = spark.createDataFrame([(at(h), f"w{h}") for h in (1, 3, 30, 31, 100)], "t timestamp, name string")
    e = spark.createDataFrame([(h, at(h)) for h in (0, 1, 2, 29, 30, 50, 99, 100, 200)], "k int, at timestamp")
    few, many = ({r.k: (r.current, r.previous) for r in tables.as_of(e, "at", s, "t", "name", most).collect()} for most in (2000, 2))
    assert few == many and few[50] == ("w100", "w31") and few[200] == (None, "w100") and few[0] == ("w1", None)


FEATURES = "course_code string, course_name string, acad_year_start int, term string, start_time string, day_of_week string, before_process_vacancy int, bidding_window string, instructor string, section string, k int"


def test_features(spark):
    rows = spark.createDataFrame([("MGMT715", "Business Ethics", 2025, "1", "19:30", "Mon", 50, "Round 1 Window 1", "JOHN DOE", "A", 1), (None, "", None, None, "nan", None, None, None, None, "B", 2)], FEATURES)
    t = features.BidFeatures("k")
    with pytest.raises(ValueError):
        t.transform(rows)
    with pytest.raises(ValueError, match="section"):
        t.fit(rows.drop("section"))
    got = {r.k: r for r in t.fit_transform(rows).collect()}
    assert len(t.get_feature_names()) == 18 and set(t.get_feature_names()) == set(got[1].asDict()) - {"k"}
    assert (got[1].subject_area, got[1].catalogue_no, got[1].round, got[1].window, got[1].has_mon, got[1].has_tue, got[1].instructor) == ("MGMT", 715, "1", 1, 1, 0, '["JOHN DOE"]')
    assert (got[2].subject_area, got[2].catalogue_no, got[2].round, got[2].window, got[2].before_process_vacancy, got[2].acad_year_start, got[2].start_time, got[2].instructor) == (None, 0, "1", 1, 0.0, 2025.0, None, None)
    assert features.filled(t.transform(rows)).filter("k = 2").first().start_time == "Unknown"
    lists = spark.createDataFrame([(1, ["A B", " ", "C D"]), (2, []), (3, ["TBA"])], "k int, who array<string>")
    none = spark.createDataFrame([], "boss_name string, afterclass_name string")
    assert {r.k: r.people for r in features.instructors(lists, "k", "who", none).collect()} == {1: ["A B", "C D"]}


def test_tokens_bootstrap_sample(spark):
    rows = spark.createDataFrame([(1, "The cat, the dog"), (2, "a cat"), (3, None), (4, "x y z the")], "k int, t string")
    assert {r.k: r.tokens for r in features.padded_tokens(rows, "k", "t", 3).collect()} == {1: [2, 1, 3], 2: [4, 2, 0], 3: [0, 0, 0], 4: [6, 7, 1]}
    many = spark.range(20_000).select((F.col("id") % 100).alias("x"))
    b = features.bootstrapped(many, "x").first()
    assert abs(b.mean - 49.5) < 0.6 and 0.1 < b.high - b.low < 2.5
    assert features.random_sample(many, 77).count() == 77 and features.random_sample(many.limit(5), 77).count() == 5


def test_safety_factors(spark):
    rng = np.random.default_rng(2)
    x = 3 + 2 * rng.standard_t(4, 4000)
    rows = [("median", float(v)) for v in x] + [("min", 7.0)] * 5 + [("median", math.inf), ("median", math.nan), ("median", None)]
    table = safety.safety_factors(spark.createDataFrame(rows, "prediction_type string, residual double"), T1).cache()
    assert table.count() == 396 and {r.multiplier for r in table.filter("prediction_type = 'min'").collect()} == {0.0}
    df, loc, scale = student_t.fit(x)
    got = {(r.multiplier_type, r.beats_percentage): r.multiplier for r in table.filter("prediction_type = 'median'").collect()}
    for p in (1, 50, 90, 99):
        assert abs(got["empirical", p] - (np.percentile(x, p) - loc) / scale) < 1e-6 and abs(got["theoretical", p] - student_t.ppf(p / 100, df)) < 1e-4
    assert safety.get_multiplier(table, "median", 90) == got["empirical", 90] and safety.get_multiplier(table, "median", 150, "theoretical") == got["theoretical", 99]
    score = spark.createDataFrame([(10.0, 2.0, 8.0, 1.0)], "median_predicted double, median_uncertainty double, min_predicted double, min_uncertainty double")
    bid = safety.predict_course_bid(score, table, 90)
    assert abs(bid["median_recommended"] - (10 + 2 * got["empirical", 90])) < 1e-9 and bid["min_recommended"] == 8.0 and bid["beats_percentage"] == 90
    # the fitted curve as a column, and its distance from the data
    f = safety.t_distribution(df, loc, scale)
    probe = spark.createDataFrame([(float(v),) for v in (-3, 3, 5, 40)], "x double").select("x", f("x").alias("f")).collect()
    assert all(abs(r.f - student_t.cdf((r.x - loc) / scale, df)) < 1e-6 for r in probe)
    assert abs(safety.critical_values(10, 0, 1)[0.95][0] - 2.2281388) < 1e-5


def test_fit_of_all_residuals(spark):
    """The fit is a maximum of the likelihood; a far value only adds its own weight."""
    rng = np.random.default_rng(5)
    groups = {"median": 3 + 2 * rng.standard_t(4, 3000), "min": rng.normal(-1, 5, 2000).round(1), "heavy": np.tan(rng.uniform(-1.5, 1.5, 1500)), "flat": np.full(9, 2.5)}
    groups["far"] = np.append(groups["median"], 1e9)
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("median", None), ("min", math.nan)]
    fits = safety.fitted(spark.createDataFrame(rows, "prediction_type string, residual double").repartition(5))
    assert fits.pop("flat") == (math.inf, 2.5, 0.0) and set(fits) == set(groups) - {"flat"}

    def likelihood(x, df, loc, scale):
        return student_t.log_density((x - loc) / scale, df).sum() - len(x) * math.log(scale)

    for k, (df, loc, scale) in fits.items():
        x, top = groups[k], likelihood(groups[k], df, loc, scale)
        for e in (1e-3, -1e-3):
            assert top >= likelihood(x, df, loc + e * scale, scale) and top >= likelihood(x, df, loc, scale * (1 + e)) and top >= likelihood(x, min(df * (1 + e), 300.0), loc, scale)
    for a, b in zip(fits["median"], student_t.fit(groups["median"]), strict=True):
        assert abs(a - b) < 1e-4 * abs(b)
    assert all(abs(a - b) < 1e-4 * abs(b) for a, b in zip(fits["far"], student_t.fit(groups["far"]), strict=True))
    assert all(abs(a - b) < w * abs(b) for a, b, w in zip(fits["far"], fits["median"], (0.25, 0.01, 0.1), strict=True))


def page(header, extra=""):
    return f'<p><SPAN id=lblClassInfoHeader class="a">{header}</SPAN></p>{extra}'


def test_pages(spark):
    grid = '<table class=g id="RadGrid_MeetingInfo_ctl00"><tbody><tr><td>EXAM</td><td>a</td><td>1-Feb-2026</td><td>Mon</td><td></td><td></td><td> Hall\n2 </td></tr><tr><td>LAB</td><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td></tr></tbody></table>'
    rows = [("/x/2025-26_T1_R1W1/SelectedAcadTerm=1&SelectedClassNumber=2.html", page("LAW&amp;1 — G1", grid)), ("/x/f/none.html", "<html>"), ("one.html", page("LAW2 — 7"))]
    made = spark.createDataFrame(rows, "filepath string, html string")
    windows = spark.createDataFrame([("R1W1", "Round 1 Window 1")], "abbreviation string, window string")
    got = {r.record_key: r for r in pages.standalone(made, windows, "now").collect()}
    assert sorted(got) == ["SelectedAcadTerm=1&SelectedClassNumber=2.html", "one.html"] and set(got["one.html"].asDict()) == {c.split()[0] for c in schemas.STANDALONE.split(", ")}
    assert got["one.html"].course_code == "LAW2" and got["SelectedAcadTerm=1&SelectedClassNumber=2.html"].bidding_window == "Round 1 Window 1"
    (m,) = pages.meetings(made).collect()
    assert (m.type, m.date, m.start_date, m.venue, m.professor_name) == ("EXAM", "2026-02-01 00:00:00.000 +0800", None, "Hall 2", "")
    assert {(r.filepath, r.error) for r in pages.errors(made).collect()} == {("/x/f/none.html", "Missing class header"), ("one.html", "Error extracting meeting information")}


class Reader(HTMLParser):
    """Text of the first element of an id, its tags counted one by one."""

    def __init__(self, name):
        super().__init__(convert_charrefs=True)
        self.name, self.open, self.out = name, None, []

    def handle_starttag(self, tag, attrs):
        if self.open is None:
            if dict(attrs).get("id") == self.name:
                self.open = [tag]
        elif self.open and tag == self.open[0]:
            self.open.append(tag)
        self.out += [" "] * bool(self.open)

    def handle_endtag(self, tag):
        self.out += [" "] * bool(self.open)
        if self.open and tag == self.open[0]:
            self.open.pop()

    def handle_data(self, data):
        if self.open and not self.cdata_elem:
            self.out.append(data)


def test_nested_elements(spark):
    rng = random.Random(2)

    def made(depth):
        out = []
        for _ in range(rng.randrange(4)):
            tag = rng.choice(["div", "DIV", "table", "span", "b", "p"])
            mark = rng.choice(["", "", ' id="x"', " id=x class=q", ' id="xx"', " data-id='x1'"])
            inside = made(depth - 1) if depth else "leaf"
            out.append(rng.choice(["text ", "a &lt; b ", "&#233;&#x41; ", "<!-- <div id=x>no</div> -->", "<br>", "<script>'</div>'</script>"]) + f"<{tag}{mark}>{inside}</{tag} >")
        return "".join(out) + rng.choice(["", " end"])

    texts = [made(4) for _ in range(300)] + ["<div id=x>never closed <b>here</b>", "<div id=x><div>a</div>b</div>c", "<div/ id=x>"]
    want = []
    for t in texts:
        reader = Reader("x")
        reader.feed(t)
        want.append(" ".join("".join(reader.out).split()) or None)
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, html string")
    got = {r.k: r.t for r in frame.select("k", pages.text_of(pages.cleaned(F.col("html")), "x").alias("t")).collect()}
    assert sum(w is not None for w in want) > 60
    assert [(texts[i], got[i]) for i in got if got[i] != want[i]] == []
    assert spark.sql("SELECT '&#0;&#xD800;&#9999999;&amp;#65;&nbsp;x' AS t").select(pages.plain(F.col("t"))).first()[0] == "\ufffd\ufffd\ufffd&#65; x"


def test_tables_in_cells(spark):
    inside = "<table><tr><td>Hall</td><td><table><tr><td>2</td></tr></table></td></tr></table>"
    grid = f'<table id="RadGrid_MeetingInfo_ctl00"><tbody><tr><td>EXAM<td>a<td>1-Feb-2026<td>Mon<td><td><td>{inside}<tr><td>EXAM</td><td>a</td><td>2-Feb-2026</td><td>Tue</td><td></td><td></td><td>X</td></tr></tbody></table><table><tbody><tr>{"<td>EXAM</td>" * 8}</tr></tbody></table>'
    made = spark.createDataFrame([("f", page("LAW1 — G1", grid))], "filepath string, html string")
    assert sorted((m.day_of_week, m.venue) for m in pages.meetings(made).collect()) == [("Mon", "Hall 2"), ("Tue", "X")]


def raw(spark, rows):
    """Standalone rows from (record_key, boss_id, course, section, window, total, enrolled)."""
    schema = schemas.STANDALONE + ", position int"
    names = [c.split()[0] for c in schema.split(", ")]
    made = [dict(record_key=k, class_boss_id=b, course_code=c, section=s, bidding_window=w, total=t, current_enrolled=e, acad_term_id=T1, acad_year_start=2025, acad_year_end=2026, term="T1", position=i) for i, (k, b, c, s, w, t, e) in enumerate(rows)]
    return spark.createDataFrame([tuple(m.get(n) for n in names) for m in made], schema)


def test_run_twice(spark, tmp_path):
    """A first run creates everything, its repetition on what was persisted changes nothing."""
    standalone = raw(spark, [("r1", 1, "LAW101", "G1", "Round 1 Window 1", 40, 10), ("r2", 2, "LAW101", "G2", "Round 1A Window 1", 30, None), ("r3", 3, "ECON5", "G1", "Round 1A Window 1", None, 5)])
    meetings = [("r1", "CLASS", "Mon", "Ann Lee, Bob Tan", 0), ("r1", "EXAM", "Fri", None, 1), ("r2", "CLASS", "Tue", "ANN LEE", 2), ("r3", "CLASS", "Wed", "TBA", 3)]
    names = [c.split()[0] for c in schemas.MULTIPLE.split(", ")]
    multiple = spark.createDataFrame([(*[dict(record_key=k, type=t, day_of_week=d, start_time="08:15", professor_name=p).get(n) for n in names], i) for k, t, d, p, i in meetings], schemas.MULTIPLE + ", position int")
    results = spark.createDataFrame([("LAW101", "G1", "Round 1 Window 1", "40", "12.5", "10")], "course_code string, section string, bidding_window string, vacancy string, median_bid string, min_bid string")
    for c in ("opening_vacancy", "before_process_vacancy", "d_i_c_e", "after_process_vacancy", "enrolled_students"):
        results = results.withColumn(c, F.lit("3"))
    scores = spark.createDataFrame([("r2", 0.9, 0.5, 20.0, 2.0, 15.0, 1.0)], "record_key string, clf_has_bids_prob double, clf_confidence_score double, median_predicted double, median_uncertainty double, min_predicted double, min_uncertainty double")
    known = spark.createDataFrame([("e1", "ECON1", "Old", "d", 1.0, 1, 9, None, None)], schemas.COURSES)
    config = market.Config(T1, standalone, multiple, results, "Round 1A Window 1", "Round 1 Window 1", {"courses": known}, scores=scores)
    out = market.run(spark, config)
    assert {r.code: r.belong_to_faculty for r in out["courses_new"].collect()} == {"LAW101": 1, "ECON5": 9}
    assert {r.name for r in out["professors_new"].collect()} == {"Ann LEE", "Bob TAN"}
    assert {(r.id, r.round, r.window) for r in out["bid_windows"].collect()} == {(1, "1", 1), (2, "1A", 1)}
    classes = out["classes_new"].collect()
    assert sorted((c.boss_id, c.warn_inaccuracy, c.professor_id is None) for c in classes) == [(1, True, False), (1, True, False), (2, False, False), (3, False, True)]
    assert out["class_timings"].count() == 4 and out["class_exam_timings"].count() == 2
    assert sorted((r.total, r.current_enrolled) for r in out["class_availabilities"].collect()) == [(0, 5), (30, 0)]
    assert sorted((r.bid_window_id, r.vacancy, r.median, r.before_process_vacancy) for r in out["bid_results_new"].collect() if r.vacancy) == [(1, 40, 12.5, 3), (1, 40, 12.5, 3), (2, 30, None, None)]
    assert out["bid_predictions"].count() == 1

    folder = str(tmp_path / "db")
    done = market.persist(out, folder, "v1")
    assert done.index("courses/new") < done.index("classes/new") < done.index("bid_results/new") and market.persist(out, folder, "v1") == []
    again = {n: market.current(spark, folder, n, known if n == "courses" else spark.createDataFrame([], s)) for n, s in market.SNAPSHOTS.items()}
    second = market.run(spark, market.Config(T1, standalone, multiple, None, "Round 1A Window 1", "Round 1 Window 1", again))
    for name in ("courses_new", "professors_new", "bid_windows", "classes_new", "classes_updated", "class_timings"):
        assert second[name].count() == 0, name


def test_previous_results_update(spark):
    classes = spark.createDataFrame([("k1", "G1", "m1", None, T1, None, None, 1, False), ("k2", "G2", "m1", None, T1, None, None, 2, False)], schemas.CLASSES)
    courses = spark.createDataFrame([("m1", "LAW1")], "id string, code string")
    windows = spark.createDataFrame([(1, T1, "1", 1)], schemas.BID_WINDOWS)
    rows = [("LAW1", "G1", "Round 1 Window 1", "x"), ("LAW1", "G2", "Round 1 Window 1", "7"), ("", "G1", "Round 1 Window 1", "7"), ("LAW1", "G1", "Round 2 Window 1", "7")]
    results = spark.createDataFrame(rows, "course_code string, section string, bidding_window string, vacancy string")
    for c in ("opening_vacancy", "before_process_vacancy", "d_i_c_e", "after_process_vacancy", "enrolled_students", "median_bid", "min_bid"):
        results = results.withColumn(c, F.lit("1.5"))
    known = spark.createDataFrame([(1, "k2")], "bid_window_id int, class_id string")
    new, updated = facts.results_of_previous(results, courses, classes, windows, known, "Round 1 Window 1", T1)
    assert [(r.class_id, r.vacancy, r.median) for r in new.collect()] == [("k1", None, 1.5)] and [(r.class_id, r.vacancy, r.enrolled_students) for r in updated.collect()] == [("k2", 7, None)]
    assert facts.in_window(results, None).count() == 0


def test_terms_and_columns(spark):
    rows = raw(spark, [("a", 1, "X", "G", "w", 1, 1), ("b", 2, "X", "G", "w", 1, 1)])
    assert [(t.id, t.term) for t in dims.new_terms(rows, spark.createDataFrame([], schemas.TERMS)).collect()] == [(T1, "1")]
    assert dims.new_terms(rows, spark.createDataFrame([(T1, 1, 1, "1", 1, "", "")], schemas.TERMS)).count() == 0
    assert dims.resolved_columns(["COURSE code", "Median Bid ($)", "x"], {"course_code": ["Course Code"], "median": ["median bid"], "gone": ["nothing"]}) == {"course_code": "COURSE code", "median": "Median Bid ($)"}


def test_titles_with_references(spark, tmp_path):
    """Titles that hold references besides &amp; are told as the SQL tells them."""
    import duckdb

    from seatloom.plans import catalog

    titles = ["token = &quot;5aa2&quot;", "a &amp;amp; b &amp;&am", "x &#39;y&#39; &lt;z", "plain"]
    rows = [(i, f"http://h/{i}", f"<html><title>{t}</title><ul><li><a href='/'>in &quot;{i}&nbsp;</a></li></ul></html>") for i, t in enumerate(titles, 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = connection.execute(catalog.ORACLES["page_records"]).fetchall()
    assert sorted(tuple(r) for r in catalog.QUERIES["page_records"](spark, str(tmp_path)).collect()) == sorted(want) and len(want) == 4
