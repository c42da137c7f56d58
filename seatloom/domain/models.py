"""The market's three models: will a class get bids, and its median and least bid. Trained on tables, scored with uncertainty."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.domain.features import CATEGORICAL, NUMERIC
from seatloom.functions import text as T
from seatloom.operators import boosting
from seatloom.operators.boosting import Params
from seatloom.runtime import table

OUTPUTS = ("clf_has_bids_prob", "clf_confidence_score", "median_predicted", "median_uncertainty", "min_predicted", "min_uncertainty")


def small() -> Params:
    """Fewer and smaller trees than the defaults, for queries and tests."""
    return Params(trees=6, depth=3, rate=0.4, refresh=8, patience=3)


@dataclass
class Models:
    has_bids: boosting.Model
    median: boosting.Model
    least: boosting.Model

    def score(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows with the eighteen features -> key and the models' outputs, as ``market.Config.scores`` takes them. Each key should be in one row."""
        p = F.col("prediction")
        sure = T.entropy_confidence(F.array(1 - p, p))
        features = rows.select(key, *CATEGORICAL, *NUMERIC)
        rename = lambda df, a, b: df.withColumnsRenamed({"prediction": a, "uncertainty": b})
        judged = self.has_bids.transform(features).withColumns({"clf_has_bids_prob": p, "clf_confidence_score": sure}).drop("prediction", "uncertainty")
        judged = rename(self.median.transform(judged), "median_predicted", "median_uncertainty")
        return rename(self.least.transform(judged), "min_predicted", "min_uncertainty").select(key, *OUTPUTS)

    def save(self, folder: str, spark: SparkSession) -> None:
        for name, model in self.__dict__.items():
            model.save(f"{folder}/{name}", spark)


def load(spark: SparkSession, folder: str) -> Models:
    return Models(*(boosting.Model.load(spark, f"{folder}/{name}") for name in ("has_bids", "median", "least")))


def train(rows: DataFrame, params: Params | None = None, test_year: int | None = None, loss: str = "squared") -> Models:
    """Rows with the eighteen features, ``median`` and ``min`` -> the models. Rows of ``test_year`` decide when to stop; the regressors take rows with such a bid.

    ``loss``: of the regressors; with "quantile" they predict the share ``params.alpha``.
    """
    params = params or Params()
    numeric = [c for c in NUMERIC]
    valid = F.col("acad_year_start") == test_year if test_year is not None else None
    bids = rows.withColumn("bids", ((F.coalesce("median", F.lit(0.0)) > 0) | (F.coalesce("min", F.lit(0.0)) > 0)).cast("double"))
    fit = lambda df, label, kind: boosting.fit(df, numeric, list(CATEGORICAL), label, replace(params, loss=kind), valid)
    return Models(fit(bids, "bids", "logistic"), fit(rows.filter("median > 0"), "median", loss), fit(rows.filter("min > 0"), "min", loss))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as classes: the customer stands for the instructor, the priority for the round, the lines' prices for the bids."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("total"), F.min("l_extendedprice").alias("least"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    day = lambda n: (F.dayofweek("o_orderdate") == n).cast("int")
    asked = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    return j.select(
        "o_orderkey", F.col("c_mktsegment").alias("subject_area"), F.col("c_nationkey").cast("string").alias("catalogue_no"), F.col("o_orderpriority").alias("round"),
        F.coalesce("lines", F.lit(0)).cast("int").alias("window"), F.coalesce("quantity", F.lit(0.0)).alias("before_process_vacancy"), F.year("o_orderdate").cast("double").alias("acad_year_start"),
        F.quarter("o_orderdate").cast("string").alias("term"), F.date_format("o_orderdate", "HH:mm").alias("start_time"), F.col("o_orderstatus").alias("course_name"),
        F.lit("G1").alias("section"), F.col("o_custkey").cast("string").alias("instructor"),
        *[day(n).alias(f"has_{d.lower()}") for d, n in zip(T.DAYS, (2, 3, 4, 5, 6, 7, 1), strict=True)],
        F.when(asked, F.col("total")).alias("median"), F.when(asked, F.col("least")).alias("min"),
    )
