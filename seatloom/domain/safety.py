"""Safety factors: multipliers of a prediction's uncertainty by the share of competitors to beat, and bids from them."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from seatloom.functions import student_t
from seatloom.operators import ranks
from seatloom.runtime import materialise

PERCENTS = range(1, 100)


def finite(residuals: DataFrame) -> DataFrame:
    """(prediction_type, residual) -> prediction_type, x: what is null or not finite is left out."""
    x = F.col("residual").cast("double")
    return residuals.select("prediction_type", x.alias("x")).filter(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


@dataclass
class Fit:
    """A type's curve so far; ``step``: how far apart (in logarithms) the next degrees of freedom are that are tried."""

    n: int
    df: float
    loc: float
    scale: float
    step: float = 0.5
    done: bool = False

    def tried(self) -> list[float]:
        return [min(max(self.df * math.exp(self.step * k), LIGHT_TAILS[0]), LIGHT_TAILS[1]) for k in range(-4, 5)]

    def next(self, sums: list[float], logs: list[float]) -> Fit:
        """The EM step for location and scale, and the best of the degrees of freedom tried."""
        shift = sums[1] / sums[0]
        loc, scale = self.loc + shift, math.sqrt(max(sums[2] - sums[1] * shift, 0.0) / self.n)
        tried = self.tried()
        likely = [self.n * (math.lgamma((d + 1) / 2) - math.lgamma(d / 2) - 0.5 * math.log(d * math.pi)) - (d + 1) / 2 * x for d, x in zip(tried, logs, strict=True)]
        best = max(range(9), key=lambda i: (likely[i], -abs(i - 4)))
        df, inside = tried[best], 0 < best < 8 or tried[best] in LIGHT_TAILS
        near = max(abs(df - self.df) / df, abs(shift) / scale if scale else 0.0, abs(scale - self.scale) / self.scale) < 1e-8
        return Fit(self.n, df, loc, scale, self.step / 3 if inside else self.step, not scale or (near and self.step < 1e-6))


#: Least and largest degrees of freedom of a fit; beyond, the curve is no t or as good as normal.
LIGHT_TAILS = (0.3, 300.0)


def fitted(residuals: DataFrame, rounds: int = 120) -> dict[str, tuple[float, float, float]]:
    """Student's t for each prediction type by maximum likelihood: (df, location, scale).

    Each round is one aggregation over all residuals, a row for each value: sums of weights, of weighted values and squares for the EM step of location and scale, and the
    likelihoods of nine degrees of freedom round the last. The driver gets a row a type. A type whose residuals are all equal has scale 0.
    """
    rows = finite(residuals)
    counted = materialise(rows.groupBy("prediction_type", "x").agg(F.count("*").alias("n")), "residuals")
    starts = ranks.quantiles(rows, ["prediction_type"], "x", [0.25, 0.5, 0.75], also={"sd": F.stddev_pop("x"), "low": F.min("x"), "high": F.max("x")})
    fits: dict[str, Fit] = {}
    for r in starts.collect():
        flat = r.low == r.high
        fits[r.prediction_type] = Fit(r.n, math.inf if flat else 5.0, r.q[1], 0.0 if flat else (r.q[2] - r.q[0]) / 1.4 or r.sd, done=flat)
    for _ in range(rounds):
        left = {k: f for k, f in fits.items() if not f.done}
        if not left:
            break
        told = residuals.sparkSession.createDataFrame([(k, f.df, f.loc, f.scale, f.tried()) for k, f in left.items()], "t_type string, df double, loc double, scale double, tried array<double>")
        d, q = F.col("x") - F.col("loc"), F.pow((F.col("x") - F.col("loc")) / F.col("scale"), 2)
        u = F.col("n") * (F.col("df") + 1) / (F.col("df") + q)
        logs = [F.sum(F.col("n") * F.log1p(q / F.get("tried", F.lit(i)))) for i in range(9)]
        met = counted.join(F.broadcast(told), F.col("prediction_type").eqNullSafe(F.col("t_type")))  # a row a type
        for r in met.groupBy("prediction_type").agg(F.array(F.sum(u), F.sum(u * d), F.sum(u * d * d)).alias("sums"), F.array(*logs).alias("logs")).collect():
            fits[r.prediction_type] = left[r.prediction_type].next(r.sums, r.logs)
    return {k: (f.df, f.loc, f.scale) for k, f in sorted(fits.items(), key=lambda x: (x[0] is not None, x[0] or ""))}


def safety_factors(residuals: DataFrame, term: str) -> DataFrame:
    """(prediction_type, residual) -> acad_term_id, prediction_type, beats_percentage, multiplier, multiplier_type: 99 x 2 rows a type.

    Empirical multipliers are exact percentiles, theoretical ones those of the fitted t, both less its location by its scale; 0 without a scale.
    """
    spark = residuals.sparkSession
    fits = fitted(residuals)
    rows = []
    for kind, (df, loc, scale) in fits.items():
        known = scale > 0
        rows += [(kind, p, loc, scale, float(student_t.ppf(p / 100, min(df, 1e6))) if known else 0.0) for p in PERCENTS]
    theory = spark.createDataFrame(rows, "prediction_type string, beats_percentage int, loc double, scale double, theoretical double")
    q = ranks.quantiles(finite(residuals), ["prediction_type"], "x", [p / 100 for p in PERCENTS]).select("prediction_type", F.posexplode("q").alias("i", "value"))
    q = q.select("prediction_type", (F.col("i") + 1).alias("beats_percentage"), "value")
    j = theory.join(q, ["prediction_type", "beats_percentage"])
    empirical = F.when(F.col("scale") > 0, (F.col("value") - F.col("loc")) / F.col("scale")).otherwise(0.0)
    kinds = F.array(F.struct(empirical.alias("multiplier"), F.lit("empirical").alias("multiplier_type")), F.struct(F.col("theoretical").alias("multiplier"), F.lit("theoretical").alias("multiplier_type")))
    return j.select(F.lit(term).alias("acad_term_id"), "prediction_type", "beats_percentage", F.inline(kinds))


def get_multiplier(factors: DataFrame, prediction_type: str, beats_percentage: int, multiplier_type: str = "empirical") -> float | None:
    """The multiplier of a percentage or of the nearest one there is, the lower of two as near."""
    rows = factors.filter((F.col("prediction_type") == prediction_type) & (F.col("multiplier_type") == multiplier_type))
    best = rows.agg(F.min_by("multiplier", F.struct(F.abs(F.col("beats_percentage") - beats_percentage), "beats_percentage"))).first()
    return best[0]


def recommended(scores: DataFrame, factors: DataFrame, levels: list[int], multiplier_type: str = "empirical") -> DataFrame:
    """Scored rows once for each level, with both multipliers and both recommended bids."""
    spark = scores.sparkSession
    wanted = spark.createDataFrame([(p,) for p in levels], "level int")
    known = factors.filter(F.col("multiplier_type") == multiplier_type)
    # a table of percentages, at most 198 rows, against a few levels
    near = wanted.join(F.broadcast(known), F.lit(True)).groupBy("level", "prediction_type").agg(F.min_by("multiplier", F.struct(F.abs(F.col("beats_percentage") - F.col("level")), "beats_percentage")).alias("m"))
    both = near.groupBy("level").agg(*[F.max(F.when(F.col("prediction_type") == t, F.col("m"))).alias(f"{t}_multiplier") for t in ("median", "min")])
    bid = lambda t: F.col(f"{t}_predicted") + F.col(f"{t}_uncertainty") * F.col(f"{t}_multiplier")
    out = scores.crossJoin(F.broadcast(both))  # a row a level
    return out.withColumns({"median_recommended": bid("median"), "min_recommended": bid("min")}).withColumnRenamed("level", "beats_percentage")


def predict_course_bid(score: DataFrame, factors: DataFrame, beats_percentage: int = 90) -> dict:
    """A course's scored row -> its scores, multipliers and recommended bids. The models that score it are the caller's."""
    return recommended(score.limit(1), factors, [beats_percentage]).first().asDict()


def bounds(predicted: Column, uncertainty: Column, actual: Column, z: float = 1.96) -> Column:
    """Confidence bounds: struct<low, high, width, inside, under>."""
    low, high = predicted - z * uncertainty, predicted + z * uncertainty
    return F.struct(low.alias("low"), high.alias("high"), (high - low).alias("width"), ((actual >= low) & (actual <= high)).alias("inside"), (predicted < actual).alias("under"))


def coverage(rows: DataFrame, predicted: str, uncertainty: str, actual: str, z: float = 1.96) -> DataFrame:
    """One row: share inside the bounds, mean width, share and mean loss of predictions that are too low."""
    b = rows.select(F.col(predicted).alias("p"), F.col(actual).alias("y"), bounds(F.col(predicted), F.col(uncertainty), F.col(actual), z).alias("b"))
    loss = F.coalesce(F.avg(F.when(F.col("b.under"), F.col("y") - F.col("p"))), F.lit(0.0))
    return b.agg(F.avg(F.col("b.inside").cast("int")).alias("coverage"), F.avg("b.width").alias("width"), F.avg(F.col("b.under").cast("int")).alias("under"), loss.alias("loss"))


def t_distribution(df: float, loc: float, scale: float):
    """Student's distribution function as a function of a column, in Arrow batches from a table of the fitted curve."""
    grid, table = student_t.cdf_table(df)

    def run(x):
        angle = np.arctan(np.abs((x.to_numpy() - loc) / scale) / np.sqrt(df))
        half = np.interp(angle, grid, table)
        return pd.Series(0.5 + np.sign(x.to_numpy() - loc) * half)

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, DoubleType())


def critical_values(df: float, loc: float, scale: float, levels: tuple[float, ...] = (0.90, 0.95, 0.99)) -> dict[float, tuple[float, float, float]]:
    """Confidence level -> (two-sided critical t, upper value, lower value)."""
    out = {}
    for level in levels:
        t = student_t.ppf(1 - (1 - level) / 2, df)
        out[level] = (t, loc + scale * t, loc - scale * t)
    return out
