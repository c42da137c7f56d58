"""Resolving person names: greedy splitting of lists against known aliases, ranked matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.functions import text as T
from seatloom.operators.similar import subset_pairs
from seatloom.operators.tables import first_per_key

# The fold takes the longest known run at each place; an unknown single word joins the name before it.
_FOLD = """
aggregate(sequence(0, size(parts) - 1), named_struct('next', 0, 'out', cast(array() AS array<string>)), (s, i) ->
  CASE WHEN i < s.next THEN s
    WHEN try_element_at(ends, i) IS NOT NULL THEN named_struct('next', try_element_at(ends, i),
      'out', concat(s.out, array(array_join(slice(parts, i + 1, try_element_at(ends, i) - i), ', '))))
    WHEN size(s.out) > 0 AND size(split(get(parts, i), '[ ]+')) = 1 THEN named_struct('next', i + 1,
      'out', concat(slice(s.out, 1, size(s.out) - 1), array(concat(element_at(s.out, -1), ', ', get(parts, i)))))
    ELSE named_struct('next', i + 1, 'out', concat(s.out, array(get(parts, i)))) END, s -> s.out)
"""


def split_names(rows: DataFrame, key: str, names: str, known: DataFrame, alias: str, shortest: bool = False) -> DataFrame:
    """Comma lists of names, which can hold commas themselves -> key, people (array), by the longest (or shortest) known runs.

    A text that is an alias as a whole is one person. Candidate runs are joined with the aliases on equality; lists are short texts, so a
    row gives few runs.
    """
    listed = rows.select(F.col(key), F.col(names).alias("text"), T.listed(F.col(names)).alias("parts"))
    runs = listed.filter(F.size("parts") > 0).select(key, "parts", F.explode(F.sequence(F.lit(0), F.size("parts") - 1)).alias("i"))
    runs = runs.select(key, "parts", "i", F.explode(F.sequence(F.col("i") + 1, F.size("parts"))).alias("j"))
    runs = runs.withColumn("run", F.upper(F.array_join(F.slice("parts", F.col("i") + 1, F.col("j") - F.col("i")), ", ")))
    aliases = known.select(F.upper(F.trim(alias)).alias("run")).distinct()
    pick = F.min if shortest else F.max
    ends = runs.join(aliases, "run").groupBy(key, "i").agg(pick("j").alias("j")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", "j"))).alias("ends"))
    whole = aliases.select(F.col("run").alias("whole"))
    joined = listed.join(ends, key, "left").withColumn("ends", F.coalesce("ends", F.create_map().cast("map<int,int>")))
    joined = joined.join(whole, F.upper(F.trim("text")) == F.col("whole"), "left")
    folded = F.when(F.size("parts") > 0, F.expr(_FOLD)).otherwise(F.array().cast("array<string>"))
    return joined.select(key, F.when(F.col("whole").isNotNull(), F.array(F.trim("text"))).otherwise(folded).alias("people"))


def resolve(
    rows: DataFrame, key: str, name: str, people: DataFrame, person: str, known_as: str, session: DataFrame | None = None, valid: DataFrame | None = None
) -> DataFrame:
    """Names -> key, person, strategy (0 literal to 5 by variation, 6 by subset of at least two words, 7 to 12 among people new in this run).

    Null where none fits. ``session``: people new in this run, (person, known_as); ``valid``: the persons that count, a match with any other is passed
    over. The subset match asks by a name's rarest word, and does not compare all pairs.
    """
    asked = rows.select(F.col(key).alias("r_k"), F.col(name).alias("n")).filter(~T.is_unset(F.col("n")))
    alias = lambda df: df.select(F.col(person).alias("r_p"), F.upper(F.trim(known_as)).alias("alias"))
    known = alias(people)
    if valid is not None:
        known = known.join(valid.select(F.col(person).alias("r_p")), "r_p", "left_semi")
    forms = asked.select("r_k", F.posexplode(T.name_variations(F.col("n"))).alias("strategy", "alias"))
    found = forms.join(known, "alias").select("r_k", "r_p", "strategy")
    pairs = subset_pairs(asked.select(F.col("n").alias("a")), known.select(F.col("alias").alias("b")))
    hits = asked.join(pairs, F.col("n") == F.col("a")).join(known.distinct(), F.col("b") == F.col("alias"))
    found = found.unionByName(hits.select("r_k", "r_p", F.lit(6).alias("strategy")))
    if session is not None:
        found = found.unionByName(forms.join(alias(session), "alias").select("r_k", "r_p", (F.col("strategy") + 7).alias("strategy")))
    best = first_per_key(found, ["r_k"], [F.col("strategy"), F.col("r_p")])
    return rows.select(F.col(key)).join(best, F.col(key) == F.col("r_k"), "left").select(key, F.col("r_p").alias(person), "strategy")
