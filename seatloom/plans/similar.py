"""Names that are like other names: the first words of users' turns asked among those of assistants' turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.operators import similar
from seatloom.plans.registry import query
from seatloom.runtime import table

SQL = """
WITH w AS (SELECT role, list_filter(regexp_split_to_array(coalesce(text, ''), '[^A-Za-z]+'), lambda x: x <> '') AS words FROM conversations),
l AS (SELECT DISTINCT array_to_string(words[1:{left}], ' ') AS a FROM w WHERE role = 'user' AND len(words) > 0),
r AS (SELECT DISTINCT array_to_string(words[1:{right}], ' ') AS b FROM w WHERE role = 'assistant' AND len(words) > 0)
"""


def sides(spark: SparkSession, sf: str, left: int, right: int) -> tuple[DataFrame, DataFrame]:
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z]+"), lambda w: w != "")
    rows = table(spark, sf, "conversations").select("role", words.alias("words")).filter(F.size("words") > 0)
    first = lambda role, n, c: rows.filter(F.col("role") == role).select(F.array_join(F.slice("words", 1, n), " ").alias(c))
    return first("user", left, "a"), first("assistant", right, "b")


@query(SQL.format(left=2, right=6) + """
SELECT a, b FROM l, r WHERE len(list_distinct(string_split(upper(a), ' '))) >= 2 AND list_has_all(string_split(upper(b), ' '), string_split(upper(a), ' '))""")
def subset_names(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of names of which all words of the first are in the second."""
    return similar.subset_pairs(*sides(spark, sf, 2, 6))


@query(SQL.format(left=1, right=1) + """
SELECT a, b, edits FROM (SELECT a, b, levenshtein(a, b)::INTEGER AS edits, row_number() OVER (PARTITION BY a ORDER BY levenshtein(a, b), b) AS place FROM l, r WHERE levenshtein(a, b) <= 2) WHERE place = 1""")
def nearest_names(spark: SparkSession, sf: str) -> DataFrame:
    """For each name the one of fewest edits, at most two."""
    return similar.nearest(*sides(spark, sf, 1, 1))


@query()
def best_names(spark: SparkSession, sf: str) -> DataFrame:
    """For each name the one of the best fuzzy score of at least 85."""
    return similar.best_alike(*sides(spark, sf, 2, 3), least=85)
