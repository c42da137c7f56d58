import numpy as np, pytest, random
from pyspark.sql import functions as F
from seatloom.operators import ranks

def test_quantiles(spark):
    rng = np.random.default_rng(1)
    rows = [("a", float(x)) for x in rng.normal(size=30_000).round(2)] + [("b", 5.0)] * 3 + [(None, 1.0), (None, 2.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.01, 0.25, 0.5, 0.9999, 1.0]
    got = {r.g: (r.n, r.q) for r in ranks.quantiles(df, ["g"], "v", shares).collect()}
    a = [v for g, v in rows if g == "a"]
    assert got["a"][0] == 30_000 and np.allclose(got["a"][1], np.quantile(a, shares)) and got["b"] == (3, [5.0] * 6) and np.allclose(got[None][1], np.quantile([1.0, 2.0], shares)) and "c" not in got
    whole = [v for _, v in rows if v is not None]
    assert np.allclose(ranks.quantiles(df, [], "v", shares, 1000).first().q, np.quantile(whole, shares))


def test_quantiles_of_a_bad_sketch_are_found_anew(spark):
    """Bounds that miss the ranks are widened until they hold them; more aggregates come along."""
    rng = np.random.default_rng(9)
    rows = [(g, float(x)) for g, n in (("a", 9000), ("b", 5000), (None, 4000), ("tiny", 3)) for x in rng.exponential(size=n)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    shares = [0.9, *(i / 40 for i in range(41)), 0.5]
    more = {"mean": F.avg("v"), "top": F.max("v")}
    for got in (ranks.quantiles(df, ["g"], "v", shares, 30, more, 1e-6), ranks.quantiles(df, ["g"], "v", shares, also=more)):
        for r in got.collect():
            v = [x for g, x in rows if g == r.g]
            assert r.n == len(v) and np.allclose(r.q, np.quantile(v, shares)) and np.isclose(r.mean, np.mean(v)) and r.top == max(v)
        assert got.count() == 4
    assert ranks.quantiles(df.limit(0), ["g"], "v", shares).count() == ranks.quantiles(df.limit(0), [], "v", shares).count() == 0


def test_bisection(spark):
    bounds = [-1.0, 0.0, 0.0, 2.5, 9.0, 9.0, 11.0]
    for size in range(8):
        row = spark.range(1).select(*[ranks.below(F.array(*map(F.lit, bounds)), size, F.lit(v)).alias(str(i)) for i, v in enumerate([-2.0, -1.0, 0.0, 1.0, 9.0, 10.0, 99.0])]).first()
        assert list(row) == [sum(b < v for b in bounds[:size]) for v in [-2.0, -1.0, 0.0, 1.0, 9.0, 10.0, 99.0]]


def test_ranks_and_ids(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), rng.randrange(500) if rng.random() < 0.7 else 7, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = {(r.g, r.v): (r.n, r.before) for r in ranks.counted_ranks(df, ["g"], "v", 16).collect()}
    assert got == {(g, v): (sum(r[:2] == (g, v) for r in rows), sum(r[0] == g and r[1] < v for r in rows)) for g, v in {r[:2] for r in rows}}
    pairs = sorted({(r[1], r[2] % 5) for r in rows})
    ids = ranks.dense_ids(spark.createDataFrame(pairs, "v int, k int"), "v", ["k"], "id", 8)
    assert {(r.v, r.k): r.id for r in ids.collect()} == {p: i for i, p in enumerate(pairs, 1)}


def test_ks_distance(spark):
    x = np.sort(np.random.default_rng(3).random(3000).round(3) ** 1.2)
    got = ranks.ks_distance(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", lambda c: c).first().ks
    n, high = len(x), np.searchsorted(x, x, "right")
    low = np.searchsorted(x, x, "left")
    assert abs(got - max((x - low / n).max(), (high / n - x).max())) < 1e-12
