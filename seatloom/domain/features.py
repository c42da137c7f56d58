"""The eighteen model features of a class, and what they are made of."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from seatloom.functions import text as T
from seatloom.operators import names as N

REQUIRED = ("course_code", "course_name", "acad_year_start", "term", "start_time", "day_of_week", "before_process_vacancy", "bidding_window", "instructor", "section")
CATEGORICAL = ("subject_area", "catalogue_no", "round", "term", "start_time", "course_name", "section", "instructor")
NUMERIC = ("window", "before_process_vacancy", "acad_year_start", *(f"has_{d.lower()}" for d in T.DAYS))
ORDER = ("subject_area", "catalogue_no", "round", "window", "before_process_vacancy", "acad_year_start", "term", "start_time", "course_name", "section", "instructor", *NUMERIC[3:])


def enriched(raw: DataFrame, multiple: DataFrame, window: str) -> DataFrame:
    """Raw rows of a window with a total, with vacancy, instructors, days and first start time of their class meetings."""
    rows = raw.filter((F.col("bidding_window") == window) & F.col("total").isNotNull())
    lesson = F.col("type") == "CLASS"
    some = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    met = multiple.groupBy(F.col("record_key").alias("m_key")).agg(
        F.array_sort(F.collect_list(F.when(some("professor_name"), F.struct("position", "professor_name"))))["professor_name"].alias("instructor"),
        F.array_join(F.array_sort(F.collect_set(F.when(lesson & some("day_of_week"), F.col("day_of_week")))), ", ").alias("day_of_week"),
        F.min(F.when(lesson & some("start_time"), F.struct("position", "start_time")))["start_time"].alias("start_time"),
    )
    j = rows.join(met, F.col("record_key") == F.col("m_key"), "left").drop("m_key")
    nobody = F.array().cast("array<string>")
    return j.withColumns(
        {"before_process_vacancy": F.col("total") - F.col("current_enrolled"), "instructor": F.coalesce("instructor", nobody), "day_of_week": F.coalesce("day_of_week", F.lit("")), "start_time": F.coalesce("start_time", F.lit(""))}
    )


def instructors(rows: DataFrame, key: str, names: str, lookup: DataFrame) -> DataFrame:
    """Instructor texts or lists -> key, ``people``: their display names, distinct and sorted; null for none.

    ``lookup``: boss_name, afterclass_name. A text that is a known name as a whole, or has no comma, is one person; others are split by the longest
    known runs. Unknown names of one word go, unless they are all there is.
    """
    column = F.col(names)
    if isinstance(rows.schema[names].dataType, ArrayType):
        column = F.array_join(F.filter(F.transform(column, lambda x: F.trim(x)), lambda x: x != ""), ", ")
    asked = rows.select(F.col(key).alias("f_key"), F.trim(column).alias("f_text")).filter("f_text IS NOT NULL AND f_text != '' AND upper(f_text) != 'TBA'")
    known = lookup.dropna(subset=["boss_name", "afterclass_name"]).groupBy(F.upper(F.trim("boss_name")).alias("alias")).agg(F.max(F.trim("afterclass_name")).alias("shown"))
    split = N.split_names(asked.select("f_text").distinct(), "f_text", "f_text", known, "alias")
    each = split.select("f_text", F.explode("people").alias("name")).join(known, F.upper("name") == F.col("alias"), "left")
    whole = ~F.col("f_text").contains(",")
    shown = F.coalesce("shown", F.when(whole | (F.size(F.split("name", r"\s+")) >= 2), F.col("name")))
    people = each.select("f_text", shown.alias("shown")).groupBy("f_text").agg(F.array_sort(F.collect_set("shown")).alias("people"))
    return asked.join(people, "f_text").select(F.col("f_key").alias(key), F.when(F.size("people") > 0, F.col("people")).alias("people"))


class BidFeatures(Transformer):
    """Rows with the ten required columns and ``key``, a column that tells them apart -> key and the eighteen features.

    ``lookup``: known names of people, (boss_name, afterclass_name); without it names stay as they are.
    """

    def __init__(self, key: str, lookup: DataFrame | None = None):
        super().__init__()
        self.key, self.lookup, self.fitted = key, lookup, False

    def fit(self, df: DataFrame) -> BidFeatures:
        """Checks the columns; there is nothing to learn."""
        missing = [c for c in REQUIRED if c not in df.columns]
        if missing:
            raise ValueError(f"Missing required columns: {missing}")
        self.fitted = True
        return self

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def get_categorical_features(self) -> list[str]:
        return list(CATEGORICAL)

    def get_numeric_features(self) -> list[str]:
        return list(NUMERIC)

    def get_feature_names(self) -> list[str]:
        return [*CATEGORICAL, *NUMERIC]

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise ValueError("Transformer must be fitted before transform. Call fit() first.")
        spark = df.sparkSession
        lookup = self.lookup if self.lookup is not None else spark.createDataFrame([], "boss_name string, afterclass_name string")
        people = instructors(df, self.key, "instructor", lookup).select(F.col(self.key).alias("p_key"), F.to_json("people").alias("p_people"))
        course, window = T.split_course(F.col("course_code")), T.parse_window(F.col("bidding_window"), generic=True)
        set_or_null = lambda c: F.when(~F.col(c).isin("", "nan"), F.col(c).cast("string"))
        columns: dict[str, Column] = {
            "subject_area": course["subject"], "catalogue_no": course["number"], "round": F.coalesce(window["round"], F.lit("1")), "window": F.coalesce(window["window"], F.lit(1)),
            "before_process_vacancy": F.coalesce(F.col("before_process_vacancy").try_cast("double"), F.lit(0.0)), "acad_year_start": F.coalesce(F.col("acad_year_start").try_cast("double"), F.lit(2025.0)),
            "term": F.coalesce(F.col("term").cast("string"), F.lit("nan")), "start_time": set_or_null("start_time"), "course_name": set_or_null("course_name"), "section": set_or_null("section"),
            "instructor": F.col("p_people"), **T.day_flags(F.col("day_of_week")),
        }
        joined = df.drop("p_key", "p_people").join(people, F.col(self.key) == F.col("p_key"), "left")
        return joined.select(self.key, *[columns[c].alias(c) for c in ORDER])


def filled(features: DataFrame) -> DataFrame:
    """Features as the models take them: missing texts as Unknown, missing numbers as 0."""
    texts = [c for c, kind in features.dtypes if kind == "string"]
    return features.select(*[(F.coalesce(F.nullif(c, F.lit("None")), F.lit("Unknown")) if c in texts else F.coalesce(c, F.lit(0).cast(kind))).alias(c) for c, kind in features.dtypes])


def padded_tokens(rows: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Texts -> key, ``tokens``: word numbers (1 is the most frequent word, then by first text), the last ``length``, with zeros after them."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]", " "), " +"), lambda w: w != "")
    listed = rows.select(F.col(key).alias("t_key"), F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    each = listed.select("t_key", F.posexplode("words").alias("i", "word"))
    vocabulary = each.groupBy("word").agg(F.count("*").alias("n"), F.min(F.struct("t_key", "i")).alias("seen"))
    numbered = vocabulary.withColumn("number", F.row_number().over(Window.orderBy(F.desc("n"), "seen"))).select("word", "number")  # a row a word of the vocabulary
    found = each.join(numbered, "word").groupBy("t_key").agg(F.array_sort(F.collect_list(F.struct("i", "number")))["number"].alias("numbers"))
    joined = listed.join(found, "t_key", "left").withColumn("numbers", F.coalesce("numbers", F.array().cast("array<int>")))
    last = F.slice("numbers", F.greatest(F.lit(1), F.size("numbers") - length + 1), length)
    return joined.select(F.col("t_key").alias(key), F.slice(F.concat(last, F.array_repeat(F.lit(0), length)), 1, length).alias("tokens"))


def bootstrapped(rows: DataFrame, value: str, rounds: int = 10, seed: int = 7) -> DataFrame:
    """One row: mean, low and high of the mean's 95 % interval, over resamples with replacement of about all rows.

    A row's weight in a resample is a Poisson draw of mean 1, so all resamples are taken in one pass.
    """
    x = F.col(value).cast("double")
    draws = [F.rand(seed * 1000 + i).alias(f"u{i}") for i in range(rounds)]
    # distribution of a Poisson draw, value by value
    steps = (0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317, 0.99940581518, 0.9999167588, 0.9999897508)
    drawn = rows.select(x.alias("x"), *draws)
    weight = lambda i: sum((F.col(f"u{i}") > p).cast("int") for p in steps)
    means = drawn.agg(F.array(*[F.sum(F.col("x") * weight(i)) / F.sum(weight(i)) for i in range(rounds)]).alias("m"))
    mean = F.aggregate("m", F.lit(0.0), lambda a, m: a + m) / rounds
    spread = F.sqrt(F.aggregate("m", F.lit(0.0), lambda a, m: a + (m - F.col("mean")) * (m - F.col("mean"))) / rounds)
    return means.withColumn("mean", mean).select("mean", (F.col("mean") - 1.96 * spread).alias("low"), (F.col("mean") + 1.96 * spread).alias("high"))


def random_sample(rows: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """At most n rows, drawn at random; the same rows on each run over the same input order."""
    return rows.withColumn("sample_key", F.rand(seed)).orderBy("sample_key").limit(n).drop("sample_key")
