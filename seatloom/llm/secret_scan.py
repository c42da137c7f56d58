"""Secret scans, with DataFrame functions only.

Base detectors are three patterns. The method adds spans by a battery of randomness tests: every long
run of key characters is a candidate; its encoding (hexadecimal, base 32, base 36 or base 64) is
inferred from the characters it uses; under that encoding three tests must not reject randomness
(chi-squared uniformity over the alphabet, number of runs about the middle of the alphabet, serial
correlation of neighbouring symbols). Candidates that pass are held against natural text: the
log-likelihood ratio of "uniform over the alphabet" to "characters by class as in this corpus" bounds the
chance that natural text of that length looks so random (a likelihood ratio exceeds x with
probability at most 1/x under the other model), so longer candidates can give smaller p-values. The
Benjamini-Hochberg rule over all candidates of the corpus turns these p-values into a cut that keeps the
false-discovery rate; its counts come from one grouped histogram of whole p-value exponents.

Base spans are blanked before candidates are taken, and a run that touches a blank is no candidate, so spans added don't overlap base
spans. Work on a text grows in proportion to its length, however many matches it holds.

Positions are code points, end exclusive. Defined cases: a null text is empty; rows that repeat are
separate documents; a null doc_id is kept; empty input gives empty output; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm import columns as C
from seatloom.runtime import materialise

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE, MIN_ACCESS = 6, 20
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
KINDS = (*BASE, "random")

#: Candidates of the randomness battery: whole runs of key characters of a length that can carry a key, away from what is blanked.
KEY = r"[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<![A-Za-z0-9+/_=\x02-]){KEY}{{20,}}+(?!\x02)"
#: Critical values of the battery at one part in a thousand: normal quantile, for each two-sided test.
Z = 3.2905
FALSE_DISCOVERY = 0.001
MARK, STAND_IN, OTHER = "\u0001", "\u0002", "\u0003"

SPANS = "array<struct<start:int,kind_no:int,stop:int,value:string>>"
#: Pieces that are measured together; even, as matches are the odd pieces.
CHUNK = 64
#: Exponents of p-values are kept as whole numbers up to this one, so the histogram has a fixed size.
TOP_EXPONENT = 400


def given(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def pieces_of(text: Column, pattern: str) -> Column:
    """The text cut at the leftmost non-overlapping matches: every odd piece is a match.

    Matches are fenced by a mark, which no pattern can match; a mark in the text itself is first exchanged for another character of that kind.
    """
    clean = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, OTHER)).otherwise(text)
    return F.split(F.regexp_replace(clean, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start,kind_no,stop,value>>.

    Pieces are measured in chunks, first the chunks' lengths, then the places inside each, so no long array is copied for every match.
    """
    nothing = F.array().cast(SPANS)

    def inside(chunk: Column, at: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            stop = state["at"] + F.char_length(piece)
            found = F.struct(state["at"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), stop.alias("stop"), piece.alias("value"))
            out = F.when(state["inside"], F.concat(state["out"], F.array(found))).otherwise(state["out"])
            return F.struct(stop.alias("at"), (~state["inside"]).alias("inside"), out.alias("out"))

        start = F.struct(at.alias("at"), F.lit(False).alias("inside"), nothing.alias("out"))
        return F.aggregate(chunk, start, step, lambda s: s["out"])

    def of_chunks(chunks: Column) -> Column:
        lengths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + F.char_length(x)))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.flatten(F.zip_with(chunks, F.slice(starts, F.lit(1), F.size(chunks)), inside))

    def chunked(pieces: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int")), lambda i: F.slice(pieces, i * CHUNK + 1, F.lit(CHUNK)))

    return F.when(text.rlike(pattern), given(given(pieces_of(text, pattern), chunked), of_chunks)).otherwise(nothing)


def fulfils(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern is long enough."""
    if kind == "assign":
        return F.char_length(F.regexp_extract(value, ASSIGN_VALUE, 1)) >= MIN_VALUE
    return F.char_length(value) >= (MIN_ACCESS if kind == "access" else 0)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, matches that fail their length rule dropped."""

    def of(kind: str) -> Column:
        return F.filter(spans_of(text, BASE[kind], kind), lambda s: fulfils(kind, s["value"]))

    return F.array_sort(F.concat(*map(of, BASE)))


def blanked(text: Column) -> Column:
    """The text with every base span exchanged for as many stand-ins."""
    clean = F.when(F.contains(text, F.lit(STAND_IN)), F.translate(text, STAND_IN, OTHER)).otherwise(text)

    def without(text: Column, kind: str) -> Column:
        def blank(piece: Column, i: Column) -> Column:
            return F.when((i % 2 == 1) & fulfils(kind, piece), F.repeat(F.lit(STAND_IN), F.char_length(piece))).otherwise(piece)

        return F.when(text.rlike(BASE[kind]), F.array_join(F.transform(pieces_of(text, BASE[kind]), blank), "")).otherwise(text)

    # each step has the text before it as a value, so none is worked out twice
    return given(given(given(clean, lambda t: without(t, "assign")), lambda t: without(t, "access")), lambda t: without(t, "hex"))


def character_costs(docs: DataFrame) -> tuple[float, float, float, float]:
    """-ln of the share of one lower-case letter, upper-case letter, digit or sign among the corpus's key characters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    classes = (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), ("[+/_-]", 4))
    counts = docs.agg(*[F.sum(F.regexp_count(text, F.lit(p)).cast("long")).alias(f"n{i}") for i, (p, _) in enumerate(classes)]).first()
    seen = [(counts[f"n{i}"] or 0) + 1 for i in range(4)]
    return tuple(-math.log(n / sum(seen) / size) for n, (_, size) in zip(seen, classes, strict=True))


def with_evidence(candidates: Column, costs: tuple[float, float, float, float]) -> Column:
    """Candidate spans -> structs with ``exponent``, the whole part of -ln p of natural text, and ``alphabet``."""
    lower, upper, digit, sign = costs

    def evidence(s: Column) -> Column:
        v = F.regexp_replace(s["value"], "=+$", "")
        k = (
            F.when(v.rlike("^[0-9a-f]+$") | v.rlike("^[0-9A-F]+$"), 16).when(v.rlike("^[A-Z2-7]+$"), 32)
            .when(v.rlike("^[0-9a-z]+$"), 36).otherwise(64)
        )
        n = [F.regexp_count(v, F.lit(p)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[+/_-]")]
        ratio = n[0] * lower + n[1] * upper + n[2] * digit + n[3] * sign - F.char_length(v) * F.log(k.cast("double"))
        return F.struct(
            s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["stop"].alias("stop"), v.alias("value"), k.alias("k"),
            F.greatest(F.lit(0), F.least(F.lit(TOP_EXPONENT), F.floor(ratio).cast("int"))).alias("exponent"),
        )

    return F.transform(candidates, evidence)


# What is no discovery needs no battery; two equal codes stand for it, which no test can pass.
# The alphabets in code order, by size; both cases and both signs of a base share a code.
BATTERY = """
transform(
 transform(
  transform(candidates, s -> struct(s.start, s.kind_no, s.stop, s.exponent, s.k,
    CASE WHEN s.exponent < {cut} OR char_length(s.value) < 2 THEN array(0, 0) ELSE
    transform(filter(split(translate(s.value, '-_', '+/'), ''), c -> c != ''), c -> instr(CASE s.k
      WHEN 16 THEN CASE WHEN s.value = lower(s.value) THEN '0123456789abcdef' ELSE '0123456789ABCDEF' END
      WHEN 32 THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
      WHEN 36 THEN '0123456789abcdefghijklmnopqrstuvwxyz'
      ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END, c) - 1) END AS codes)),
  s -> struct(s.start, s.kind_no, s.stop, s.exponent, s.k, s.codes, CAST(size(s.codes) AS DOUBLE) AS n,
    aggregate(s.codes, 0D, (a, c) -> a + c) / size(s.codes) AS mean,
    aggregate(array_distinct(s.codes), 0D, (a, c) -> a + pow(size(filter(s.codes, x -> x = c)), 2)) AS squares,
    CAST(size(filter(s.codes, c -> c >= s.k / 2)) AS DOUBLE) AS high,
    1D + size(filter(sequence(1, size(s.codes) - 1), i -> (s.codes[i] >= s.k / 2) != (s.codes[i - 1] >= s.k / 2))) AS runs)),
 s -> struct(s.start, s.kind_no, s.stop, s.exponent,
   -- Wilson-Hilferty: the cube root of chi-squared over its freedom is close to normal
   (cbrt((s.squares * s.k / s.n - s.n) / (s.k - 1)) - (1 - 2D / (9 * (s.k - 1)))) / sqrt(2D / (9 * (s.k - 1))) AS z_chi,
   try_divide(s.runs - 1 - 2 * s.high * (s.n - s.high) / s.n,
     sqrt(greatest(0D, 2 * s.high * (s.n - s.high) / s.n * (2 * s.high * (s.n - s.high) / s.n - 1) / (s.n - 1)))) AS z_runs,
   try_divide(aggregate(sequence(1, size(s.codes) - 1), 0D, (a, i) -> a + (s.codes[i] - s.mean) * (s.codes[i - 1] - s.mean)),
     aggregate(s.codes, 0D, (a, c) -> a + pow(c - s.mean, 2))) * sqrt(s.n) AS z_serial))
"""


def false_discovery_exponent(exponents: DataFrame, rate: float) -> int:
    """Benjamini-Hochberg over rows of ``exponent``: the least exponent that counts as a discovery.

    With c(t) of m candidates at exponent t or more, the rule takes the largest p = exp(-t) that is at
    most rate * c(t) / m. Only the histogram, of at most TOP_EXPONENT + 1 rows, comes to the driver.
    """
    counts = {r["exponent"]: r["count"] for r in exponents.groupBy("exponent").count().collect()}
    m, above, cut = sum(counts.values()), 0, TOP_EXPONENT + 1
    for t in range(TOP_EXPONENT, 0, -1):
        above += counts.get(t, 0)
        if above and math.exp(-t) <= rate * above / m:
            cut = t
    return cut


def plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["stop"].alias("stop")))


def marked(rows: DataFrame, cut: int) -> DataFrame:
    """Rows with ``base`` and ``candidates`` -> the same with ``base``, ``spans`` and ``passed`` (for each candidate) for an exponent cut."""
    within = lambda c: F.coalesce(F.abs(c) < Z, F.lit(False))
    tested = rows.withColumn("tested", F.when(F.size("candidates") > 0, F.expr(BATTERY.replace("{cut}", str(cut)))))
    tested = tested.withColumn("passed", F.transform("tested", lambda s: within(s["z_chi"]) & within(s["z_runs"]) & within(s["z_serial"])))
    found = F.filter(F.arrays_zip("tested", "passed"), lambda s: s["passed"])
    added = F.coalesce(plain(F.transform(found, lambda s: s["tested"])), F.array().cast("array<struct<start:int,kind_no:int,stop:int>>"))
    spans = F.array_sort(F.concat(plain(F.col("base")), added))
    return tested.withColumns({"base": plain(F.col("base")), "spans": spans}).drop("candidates", "tested")


def candidates(text: Column, costs: tuple[float, float, float, float]) -> Column:
    """The battery's candidates in a text, with their evidence."""
    return with_evidence(spans_of(text, CANDIDATE, "random"), costs)


def found_in(rows: DataFrame, text: Column, costs: tuple[float, float, float, float]) -> DataFrame:
    """Rows with ``base`` spans and ``candidates`` of a text that isn't null."""
    based = rows.withColumn("base", base_spans(text))
    clear = F.when(F.size("base") > 0, blanked(text)).otherwise(text)
    # few texts hold a run that is long enough, so few are blanked
    return based.withColumn("candidates", F.when(text.rlike(KEY + "{20}"), given(clear, lambda t: candidates(t, costs))))


def scan(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Documents -> doc_id, ``base`` and ``spans``: arrays of struct<start,kind_no,stop>, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = materialise(found_in(docs.select("doc_id", text.alias("text")), F.col("text"), character_costs(docs)).drop("text"), "secrets")
    return marked(found, false_discovery_exponent(found.select(F.explode("candidates.exponent").alias("exponent")), rate))


def redact(docs: DataFrame, rate: float = FALSE_DISCOVERY, stand_in: str = "[secret]") -> DataFrame:
    """Documents with every span replaced in ``text`` and ``n_chars`` counted anew, if there is such a column; no row is dropped.

    Spans that overlap or touch are one gap.
    Texts are scanned once for the corpus's statistics and once to be changed where they are, so no text is shuffled.
    """
    costs = character_costs(docs)
    runs = docs.filter(F.col("text").rlike(KEY + "{20}")).select("text")
    evidence = found_in(runs, F.col("text"), costs).select(F.explode("candidates.exponent").alias("exponent"))
    cut = false_discovery_exponent(evidence, rate)
    body = C.own("text")
    rows = found_in(C.hidden(docs).withColumn("whole", F.coalesce(body, F.lit(""))), F.col("whole"), costs)

    def step(state: Column, span: Column) -> Column:
        between = F.concat(state["out"], F.substring(body, state["at"] + 1, span["start"] - state["at"]), F.lit(stand_in))
        return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), F.when(span["start"] >= state["at"], between).otherwise(state["out"]).alias("out"))

    def gap(piece: Column, i: Column) -> Column:
        return F.when((i % 2 == 1) & F.get("passed", F.floor(i / 2).cast("int")), F.repeat(F.lit(STAND_IN), F.char_length(piece))).otherwise(piece)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    folded = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.char_length(body))))
    gaps = F.array_join(F.transform(pieces_of(given(blanked(body), lambda t: t), CANDIDATE), gap), "")
    cleaned = F.regexp_replace(gaps, f"{STAND_IN}+", stand_in.replace("\\", "\\\\").replace("$", "\\$"))
    # a text that holds the marks itself is folded span by span
    text = F.when(F.size("spans") == 0, body).when(body.rlike(f"[{MARK}{STAND_IN}]"), folded).otherwise(cleaned)
    out = marked(rows, cut).withColumn("text", text)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(C.own("n_chars"))
    return C.shown(out, docs.columns, **changed)


def rendered(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind_no"] == KINDS.index(kind))).cast("long")
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(rendered(F.col("base")), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"),
    )
