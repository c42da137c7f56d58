"""License scans, with DataFrame functions only.

Base: places where the words of a fixed phrase stand consecutively. The method adds labels by an exact
set-similarity join of text blocks with license templates. A block is a run of consecutive words, wherever lines end, of at most
``slack`` times as many words as the template has; it meets the template when it holds at least ``threshold`` of the template's distinct
words and all its required words (those that tell it from its kin: "nc" from "sa").

Words are ordered by how many texts of the corpus hold them, rarest first. A template of size s needs need = ceil(threshold * s)
common words, so a block that meets it must hold one of its first s - need + 1 words (prefix filter). Each place of such a word in a
text is a probe: it opens the words that can share a block with it. Of these at least ``need`` must be distinct words that any template
has (length filter), and at least ``need`` of them must not be rarer than the probe (positional filter: a block counts at its
first common word in the global order, so nothing before the probe can be common). What remains is verified exactly, block by block.

Templates are parameters of the operator, not data, so the prefix index they form is small by
construction and is sent along with the join. Texts travel as the places of their words known to some template,
where these words are enough for one; no text is shuffled.

Defined cases: a null text is empty (n_words 0, no labels, score 0); rows that repeat are separate
documents; a null doc_id is kept; empty input gives empty output; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.runtime import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One word character, and a gap, in text whose A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Notices that the set-similarity join looks for, by label, and the words without which none of them stands.
TEMPLATES = {
    "mit": ("Released under the MIT License", "mit license"),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission granted software"),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0", "apache license 2"),
    "gpl": ("This work is licensed under the GNU General Public License", "gnu general public license"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution source binary permitted"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License", "mozilla public license"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "cc by nc"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "cc by sa"),
    "cc-by": ("This work is licensed under a Creative Commons Attribution International License", "creative commons attribution license"),
    "cc0": ("dedicated to the public domain under CC0 1.0 Universal", "public domain cc0"),
    "reserved": ("Copyright all rights reserved", "all rights reserved"),
}
THRESHOLD = 0.8
#: A block has at most so many times the words of its template.
SLACK = 1.5


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all other characters kept; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words of lower-cased text, in order."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def places_of(words: Column, phrase: str, label: str) -> Column:
    """Word positions from which the phrase's words stand in a row, as array<struct<start,label>>."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + k) == part)
        return test

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]  # distinct
    required: tuple[str, ...]
    need: int  # common words
    length: int  # most words of a block


def compiled(templates: dict[str, tuple[str, str]], threshold: float = THRESHOLD, slack: float = SLACK) -> list[Template]:
    """Templates as word sets; templates without words are left out."""
    low = lambda text: re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))
    out = []
    for name, (text, required) in templates.items():
        words = low(text)
        if words:
            out.append(Template(name, tuple(sorted(set(words))), tuple(sorted(set(low(required)))), math.ceil(threshold * len(set(words)) - 1e-9), math.ceil(slack * len(words) - 1e-9)))
    return out


def strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def similar_blocks(texts: DataFrame, templates: list[Template]) -> DataFrame:
    """doc_id, text_hash, template, containment for every text and template of which some block meets it."""
    spark = texts.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words})
    hopeful = F.lit(False)
    for t in templates:
        enough = F.size(F.array_intersect("known", strings(t.words))) >= t.need
        hopeful = hopeful | (enough & (F.size(F.array_intersect("known", strings(t.required))) == len(t.required)))
    listed = strings(vocabulary)
    placed = F.transform(words_of(F.col("low")), lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    blocks = (
        texts.withColumn("known", F.array_intersect(F.split("low", GAP), listed))
        # few texts hold enough of a template anywhere
        .select("doc_id", "text_hash", "known", F.when(hopeful, F.filter(placed, lambda p: F.array_contains(listed, p["word"]))).alias("places"))
    )
    blocks = materialise(blocks, "blocks")

    counts = blocks.select(F.explode("known").alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counts.collect()}  # at most the templates' own words
    ordered = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    index = []
    for t in templates:
        mine = sorted(rank[w] for w in t.words)
        index += [(r, t.name, mine, [rank[w] for w in t.required], t.need, t.length) for r in mine[: len(mine) - t.need + 1]]
    prefix = spark.createDataFrame(index, "probe int, template string, words array<int>, required array<int>, need int, length int")
    probes = F.array(*[F.lit(r) for r in sorted({row[0] for row in index})])
    ranks = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])

    ranked = F.transform("places", lambda p: F.struct(p["at"].alias("at"), F.element_at(ranks, p["word"]).alias("rank")))
    met = blocks.filter("places IS NOT NULL").select("doc_id", "text_hash", ranked.alias("places"))
    met = met.select("doc_id", "text_hash", "places", F.explode(F.sequence(F.lit(0), F.size("places") - 1)).alias("i")).withColumn("spot", F.get("places", F.col("i")))
    # a block holds no more places than words, so what can share one with the probe stands next to it in the list
    reach = F.col("length")
    near = F.slice("places", F.greatest(F.lit(1), F.col("i") + 2 - reach), reach + F.least(F.col("i") + 1, reach) - 1)
    near = F.filter(near, lambda p: F.abs(p["at"] - F.col("spot.at")) < reach)
    size = lambda c: F.size(F.array_distinct(c))
    candidates = (
        met.filter(F.array_contains(probes, F.col("spot.rank")))
        .join(F.broadcast(prefix), F.col("spot.rank") == F.col("probe"))
        .withColumn("near", near)
        .filter(size(F.col("near.rank")) >= F.col("need"))
        .filter(size(F.filter(F.col("near.rank"), lambda r: r >= F.col("probe"))) >= F.col("need"))
        .select("doc_id", "text_hash", "template", "words", "required", "need", "length", F.filter("near", lambda p: F.array_contains("words", p["rank"])).alias("near"))
        .filter(F.size("near") > 0)
    )

    def block(i: Column) -> Column:
        """Distinct words of the template in the longest block that begins at the i-th place; 0 without those required."""
        first = F.get("near", i)["at"]
        held = F.array_distinct(F.filter(F.slice("near", i + 1, F.col("length")), lambda p: p["at"] < first + F.col("length"))["rank"])
        return F.when(F.size(F.array_except("required", held)) == 0, F.size(held)).otherwise(0)

    most = F.array_max(F.transform(F.sequence(F.lit(0), F.size("near") - 1), block))
    found = candidates.select("doc_id", "text_hash", "template", "need", F.size("words").alias("size"), most.alias("most")).filter("most >= need")
    return found.groupBy("doc_id", "text_hash", "template").agg((F.max("most") / F.first("size")).alias("containment"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    slack: float = SLACK,
) -> DataFrame:
    """Documents -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest containment met, or 1 where a base phrase stands.
    """
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), lowered(F.col("text")).alias("low"))
    standing = F.col("low").rlike("|".join(GAP.join(p.split()) for p in phrases)) if phrases else F.lit(False)
    hits = F.concat(F.array().cast("array<struct<start:int,label:string>>"), *[places_of(F.col("words"), p, label) for p, label in phrases.items()])
    base = (
        texts.select(
            "doc_id", "text_hash", F.regexp_count("low", F.lit(WORD)).cast("long").alias("n_words"),
            F.when(standing, words_of(F.col("low"))).alias("words"),  # few texts are cut into words here
        )
        .withColumn("hits", F.when(F.col("words").isNotNull(), hits))
        .select(
            "doc_id", "text_hash", "n_words",
            F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_base"),
            F.array_min("hits.start").cast("long").alias("first_word"),
            F.array_max("hits.start").cast("long").alias("last_word"),
            F.coalesce(F.array_distinct("hits.label"), F.array().cast("array<string>")).alias("base_list"),
        )
    )
    found = similar_blocks(texts, compiled(templates, threshold, slack)).groupBy("doc_id", "text_hash").agg(
        F.collect_set("template").alias("added"), F.max("containment").alias("containment")
    )
    found = found.select(F.col("doc_id").alias("f_doc_id"), F.col("text_hash").alias("f_hash"), "added", "containment")
    joined = base.join(found, (F.col("text_hash") == F.col("f_hash")) & F.col("doc_id").eqNullSafe(F.col("f_doc_id")), "left")
    every = F.array_union("base_list", F.coalesce("added", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_list"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
