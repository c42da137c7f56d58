"""Boosted trees against a split search by hand; scans against Spark's windows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seatloom.domain import models
from seatloom.operators import boosting, scans


def brute(x, y, trees, depth, rate, l2, loss, alpha=0.5):
    """Symmetric trees by trying every value of every feature; returns the training rows' raw scores."""
    n, width = x.shape
    raw = np.full(n, {"squared": np.mean(y), "logistic": math.log(np.mean(y) / (1 - np.mean(y))) if loss == "logistic" else 0, "quantile": np.quantile(y, alpha)}[loss])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g = {"squared": raw - y, "logistic": p - y, "quantile": np.where(raw > y, 1 - alpha, -alpha)}[loss]
        h = p * (1 - p) if loss == "logistic" else np.ones(n)
        leaf = np.zeros(n, int)
        for _ in range(depth):
            found = []
            for f in range(width):
                for i, value in enumerate([math.nan, *sorted(set(x[~np.isnan(x[:, f]), f]))[:-1]]):
                    right = ~np.isnan(x[:, f]) if i == 0 else x[:, f] > value
                    gain = 0
                    for k in set(leaf):
                        node = leaf == k
                        for part in (node & right, node & ~right):
                            gain += g[part].sum() ** 2 / (h[part].sum() + l2)
                        gain -= g[node].sum() ** 2 / (h[node].sum() + l2)
                    found.append((-round(gain, 9), f, i, right))
            _, _, _, right = min(found, key=lambda s: s[:3])
            leaf = leaf * 2 + right
        for k in set(leaf):
            node = leaf == k
            step = np.quantile(y[node] - raw[node], alpha) if loss == "quantile" else -g[node].sum() / (h[node].sum() + l2)
            raw[node] += rate * step
    return raw


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for i in range(300):
        a, b, c = rng.randrange(12), rng.choice([None, 0.5, 1.5, 2.5, float("nan")]), rng.gauss(0, 1)
        y = 3 * (a > 6) + (0 if b is None or b != b else b) * (a % 2) + 0.1 * rng.randrange(10)
        out.append((i, float(a), b, round(c, 1), y, float(y > 2.2), rng.choice(["x", "y", None])))
    return spark.createDataFrame(out, "id long, a double, b double, c double, y double, won double, kind string").repartition(5)


@pytest.mark.parametrize(("loss", "label"), [("squared", "y"), ("logistic", "won"), ("quantile", "y")])
def test_trees_are_those_of_brute_force(rows, loss, label):
    params = boosting.Params(loss=loss, trees=3, depth=2, rate=0.5, l2=1.0, alpha=0.7, refresh=2, bins=100)
    model = boosting.fit(rows, ["a", "b", "c"], [], label, params)
    got = {r.id: r.prediction for r in model.transform(rows).collect()}
    told = sorted(rows.collect(), key=lambda r: r.id)
    x = np.array([[math.nan if v is None else v for v in (r.a, r.b, r.c)] for r in told])
    want = brute(x, np.array([r[label] for r in told]), 3, 2, 0.5, 1.0, loss, 0.7)
    want = 1 / (1 + np.exp(-want)) if loss == "logistic" else want
    assert np.allclose([got[r.id] for r in told], want, atol=1e-9)


def test_ordered_statistics_use_earlier_rows_only(spark, rows):
    made = rows.withColumn("one", F.lit("same"))
    got = {r.id: r.stats for r in boosting.ordered_statistics(made, "id", ["id"], ["kind", "one"], "y", 1.0, 2.0).collect()}
    seen = {}
    for r in sorted(made.collect(), key=lambda r: r.id):
        for i, category in enumerate((r.kind, "same")):
            total, n = seen.get((i, category), (0.0, 0))
            assert math.isclose(got[r.id][i], (total + 2.0) / (n + 2.0))
            seen[(i, category)] = total + r.y, n + 1


def test_ordered_statistics_deal_rows_once(spark, rows, monkeypatch):
    """Rows aren't written or dealt once for each category; ranges of the order give what one range gives, whatever is kept beside."""
    written, keep = [], boosting.materialise
    monkeypatch.setattr(boosting, "materialise", lambda df, name, **k: (written.append((name, keep(df, name, **k))), written[-1][1])[1])
    made = rows.withColumn("one", F.lit("same")).withColumn("own", F.col("id").cast("string"))
    args = ["id", [F.md5(F.col("id").cast("string")), "id"], ["kind", "one", "own"], "y", 1.0, 2.0]
    parts = boosting.ordered_statistics(made, *args, keep=("y", "c"), ranges=7)
    got, whole = ({r.id: r for r in df.collect()} for df in (parts, boosting.ordered_statistics(made, *args, ranges=1)))
    assert [df.count() for _, df in written] == [300, 300] and written[0][1].select("s_range").distinct().count() > 4
    assert parts.columns == ["id", "y", "c", "stats"] and len(got) == 300
    for r in rows.collect():
        assert (got[r.id].y, got[r.id].c) == (r.y, r.c) and np.allclose(got[r.id].stats, whole[r.id].stats, rtol=1e-12) and got[r.id].stats[2] == 1.0


def test_bins_as_bytes():
    bins = np.random.default_rng(3).integers(0, 250, (50, 7), np.uint8)
    column = boosting.packed(bins)
    assert column.to_pylist() == [x.tobytes() for x in bins]
    assert (boosting.unpacked(column[11:30], 7) == bins[11:30]).all() and boosting.unpacked(column[:0], 7).shape == (0, 7)


def test_early_stopping_and_categories(spark, rows, tmp_path):
    rng = random.Random(1)
    worth = {f"g{i}": rng.gauss(0, 3) for i in range(20)}
    made = [(f"g{rng.randrange(20)}", rng.random(), i % 4 == 0) for i in range(2000)]
    df = spark.createDataFrame([(g, x, v, worth[g] + rng.gauss(0, 0.5)) for g, x, v in made], "g string, x double, held boolean, y double")
    params = boosting.Params(trees=12, depth=2, rate=0.6, l2=1.0, patience=3, refresh=3)
    model = boosting.fit(df, ["x"], ["g"], "y", params, F.col("held"))
    assert 0 < len(model.trees) <= 12
    held = [v for _, v in model.losses]
    assert len(model.trees) == held.index(min(held))
    out = model.transform(df.filter("held")).select(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)), F.min("uncertainty")).first()
    assert math.isclose(out[0], min(held), rel_tol=1e-9)
    assert out[0] < 1.0 and out[1] > 0
    model.save(f"{tmp_path}/m", spark)
    again = boosting.Model.load(spark, f"{tmp_path}/m")
    unknown = spark.createDataFrame([("never", 0.5), (None, None), ("g1", 0.1)], "g string, x double")
    score = lambda m: [r.prediction for r in m.transform(unknown).orderBy("x").collect()]
    assert score(again) == score(model)


def test_no_rows_and_flat_labels(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "x double, y double")
    model = boosting.fit(df, ["x"], [], "y", boosting.Params(trees=3, depth=2))
    assert not model.trees and {r.prediction for r in model.transform(df).collect()} == {5.0}
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(df.limit(0), ["x"], [], "y")
    assert model.transform(df.limit(0)).count() == 0


def test_slices():
    model = boosting.Model([], [], boosting.Params(), trees=[boosting.Tree([], [], [1.0])] * 23)
    assert model.slices() == [(2 * i, 2 * i + 2) for i in range(10)]
    assert boosting.Model([], [], boosting.Params(), trees=model.trees[:3]).slices() == [(0, 1), (1, 2), (2, 3)]


def test_market_models(spark, sf_dir):
    """Two regressors and a classifier on orders; better than the mean."""
    rows = models.training_rows(spark, sf_dir)
    trained = models.train(rows, models.small(), test_year=1998)
    scores = trained.score(rows.filter("acad_year_start = 1998").withColumnRenamed("o_orderkey", "record_key"), "record_key")
    assert scores.columns == ["record_key", *models.OUTPUTS]
    assert scores.filter("clf_has_bids_prob BETWEEN 0 AND 1 AND median_uncertainty >= 0").count() == rows.filter("acad_year_start = 1998").count()


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_running(spark, ranges):
    rng = random.Random(4)
    data = [(rng.choice([None, "hot", "hot", "hot", *"abcdef"]), rng.choice([None, *range(400)]), i, rng.choice([None, *range(-9, 9)])) for i in range(900)]
    df = spark.createDataFrame(data, "k string, at int, id int, v int").repartition(6)
    w = Window.partitionBy("k").orderBy(F.asc_nulls_first("at"), "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.sum("v").over(before).alias("s"), F.max("v").over(before).alias("m"), F.lag("v").over(w).alias("l"), F.min("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("i"))
    got = scans.running(df, ["k"], ["at", "id"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, ranges=ranges)
    got = scans.lagged(got, ["k"], ["at", "id"], "v", "l", ranges)
    got = scans.running(got, ["k"], ["at", "id"], {"i": ("min", F.col("v"))}, True, ranges)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_runs(spark):
    rng = random.Random(8)
    data = [("hot" if i % 3 else f"k{i % 5}", i, rng.choice([True, True, True, False, None])) for i in range(700)]
    df = spark.createDataFrame(data, "k string, at int, up boolean").repartition(4)
    length, want = {}, []
    for k, at, up in data:
        length[k] = length.get(k, 0) + 1 if up else 0
        want.append((k, at, length[k]))
    got = scans.runs(df, ["k"], ["at"], F.col("up"), "run", 9).select("k", "at", "run").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert scans.runs(df.limit(0), [], ["at"], F.col("up"), "run").count() == 0


def test_tasks_of_scans_stay_small(spark, monkeypatch):
    """Ranges grow in number and not in size with the rows, also of one hot group; a largest struct of many equal first fields is right."""
    monkeypatch.setattr(scans, "ROWS", 100)
    rows = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id"), (F.col("id") % 7).alias("v"), F.when(F.col("id") > 900, F.col("id") % 2).alias("h"))
    found = scans.running(rows, ["k"], ["id"], {"n": ("sum", F.lit(1)), "top": ("max", F.struct("h", "v", "id")), "low": ("min", F.struct("v", "h"))})
    assert found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 500
    best, low = None, None
    key = lambda t: tuple((x is not None, x or 0) for x in t)
    for r in found.orderBy("id").collect():
        assert (r.n or 0) == r.id and (tuple(r.top) if r.top else None) == best and (tuple(r.low) if r.low else None) == low
        mine, least = (r.h, r.v, r.id), (r.v, r.h)
        best = mine if best is None or key(mine) > key(best) else best
        low = least if low is None or key(least) < key(low) else low


def test_scans_carry_no_order(spark, tmp_path, monkeypatch):
    """An order that is an expression is in no written table, and gives what a column of it gives."""
    written, keep = [], scans.materialise
    monkeypatch.setattr(scans, "materialise", lambda df, name, **k: written.append(df.columns) or keep(df, name, **k))
    df = spark.range(300).select((F.col("id") % 2).alias("k"), "id", (F.col("id") % 5).alias("v"))
    order = F.md5(F.col("id").cast("string"))
    got = scans.running(df, ["k"], [order, "id"], {"s": ("sum", F.col("v"))}, ranges=4)
    want = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy(order, "id").rowsBetween(Window.unboundedPreceding, -1)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and written[0] == ["k", "id", "v", "_range"]
