"""Substring dedup: removes words of long passages that stand earlier in the corpus.

The runs of ``width`` words are the edges of the corpus's De Bruijn graph, its nodes the runs of width - 1 words. Storing every
edge would take several times the text, so edges are compacted into paths before anything is shuffled:

* Each edge has an anchor, the first of the least hashes of its ``width - span + 1`` inner runs of ``span`` words. Neighbouring edges
  mostly share one; a stretch of neighbours with one anchor is a path. Equal edges have equal anchors at equal places.
* First pass: paths are counted by anchor through one partial aggregation, which also tells the degrees of the nodes at their
  ends. An anchor seen once has no repeated edge. An anchor with different paths is where the graph branches. A path whose
  neighbours in the text are the same wherever it stands is free: the nodes at both ends have one way in and one way out.
* Second pass: neighbouring free paths are compacted into one piece, however long. Other paths of repeated anchors are pieces of
  their own; those of branching anchors are opened into single edges.
* A piece is told by a 128-bit BLAKE2b digest of the words that stand at its source coordinates (doc_id, hash of the text, word
  position), so equal pieces have equal words, not only equal edge hashes. Pieces are joined with their first occurrence; all
  others are repeats, and their coordinates give the words to remove.

The facts about anchors go to the second pass as bit sets of eight bits an anchor, of ``max_bits`` at most. They save work only: an anchor
that falls into a set by chance makes a path be shuffled, not compacted or opened for nothing, everywhere alike, and changes no
result. Where that many bits aren't enough, paths are joined with their anchors instead, and rows with the paths found.

Defined cases: a null text has no words; a document of fewer than ``width`` words loses none; rows with
equal doc_id and equal place are not earlier than each other; a null doc_id is before all others; rows of one doc_id, or of
none, with different texts lose their own repeats alone; empty input gives empty output; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm import words as W
from seatloom.runtime import discard, in_arrow, materialise

WIDTH = 20
SPAN = 8
#: Largest bit set that is sent to tasks (32 MB), and bits for each of its members.
MAX_BITS, MEMBER_BITS = 1 << 28, 8

_NO_PATH = np.uint64(0x5EA7)


@dataclass
class Paths:
    """Paths of some texts. Arrays over paths, in order of their place in the slice's words."""

    text: np.ndarray  # number of the text
    place: np.ndarray  # first edge's word position in its text
    count: np.ndarray  # edges
    anchor: np.ndarray
    start: np.ndarray  # first edge's word position in the slice
    path: np.ndarray  # hash of the path's edges
    context: np.ndarray  # hash of the path and its neighbours in the text
    words: W.Words


def path_hashes(start: np.ndarray, count: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Order-bound hash of each path's edges: first and last edge and their number fix all words between,
    together with the sum of all edges."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(edges)])
        total = sums[start + count] - sums[start]
        return W.mix(total + W.mix(edges[start] + np.uint64(1)) * np.uint64(3) + W.mix(edges[start + count - 1] + count.astype(np.uint64)))


def paths_of(texts: list[bytes | None], width: int, span: int) -> Paths:
    words = W.Words(texts)
    h = words.hashes()
    n = len(h) - width + 1
    if n <= 0:
        none, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Paths(none, none, none, bits, none, bits, bits, words)
    inside = words.text[:n] == words.text[width - 1 :]
    runs = W.window_hashes(h, span, 1)
    least = W.sliding_min(runs, width - span + 1)
    new = np.ones(n, bool)
    # the anchor is the first least run of an edge; in periodic text the next edge can have an equal one further on
    new[1:] = (least[1:] != least[:-1]) | (runs[: n - 1] == least[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new & inside)
    # a path ends before the next start or before the first edge that leaves its text
    change = np.flatnonzero(new | ~inside)
    count = np.append(change, n)[np.searchsorted(change, start, "right")] - start
    text = words.text[start]
    path = path_hashes(start, count, W.window_hashes(h, width, 2))
    same = text[1:] == text[:-1]
    with np.errstate(over="ignore"):
        before, after = np.full(len(path), _NO_PATH), np.full(len(path), _NO_PATH)
        before[1:][same], after[:-1][same] = path[:-1][same], path[1:][same]
        context = W.mix(W.mix(before + np.uint64(5)) * np.uint64(3) + path + W.mix(after + np.uint64(9)) * np.uint64(7))
    return Paths(text, start - words.first[text], count, least[start], start, path, context, words)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _spots(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of an anchor."""
    return [(W.mix(anchor + np.uint64(s)) % np.uint64(bits)).astype(np.int64) for s in (11, 12)]


def _holds(bitset: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    out = np.ones(len(anchor), bool)
    for spot in _spots(anchor, len(bitset) * 64):
        out &= (bitset[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def bits_for(members: int) -> int:
    """Bits of a set for so many members."""
    return max(1 << 12, 1 << (members * MEMBER_BITS - 1).bit_length() if members else 0)


def bit_set(kept: DataFrame, bits: int) -> np.ndarray:
    """Anchors -> bit set. What comes to the driver is at most bits / 64 rows of two numbers, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            spots = np.unique(np.concatenate(_spots(anchor, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(spots >> 6), _signed(np.uint64(1) << (spots & 63).astype(np.uint64))], ["word", "bit"]
            )

    rows = in_arrow(kept.select("anchor"), run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def anchors(docs: DataFrame, width: int, span: int) -> DataFrame:
    """First pass: anchors that repeat, ``branches`` (with different paths) and ``bound`` (with different neighbours); written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for a, b in W.slices(texts):
                p = paths_of(texts.slice(a, b - a).to_pylist(), width, span)
                yield pa.RecordBatch.from_arrays([_signed(p.anchor), _signed(p.path), _signed(p.context)], ["anchor", "path", "context"])

    both = lambda c: (F.min(c) != F.max(c))
    counted = in_arrow(docs.select("text"), run, "anchor long, path long, context long").groupBy("anchor")
    counted = counted.agg(F.count("*").alias("n"), both("path").alias("branches"), both("context").alias("bound"))
    return materialise(counted.filter("n > 1").drop("n"), "anchors")


def text_key() -> Column:
    """With doc_id, tells rows apart."""
    return F.xxhash64("text").alias("text_key")


#: Tells for paths of rows a to b - 1 of a batch which repeat, branch and are bound.
Facts = Callable[[pa.RecordBatch, int, int, Paths], tuple[np.ndarray, np.ndarray, np.ndarray]]


def facts_by_sets(by_anchor: DataFrame, bits: int) -> Facts:
    send = by_anchor.sparkSession.sparkContext.broadcast
    sets = [send(bit_set(by_anchor.filter(c), bits)) for c in ("true", "branches", "bound")]
    return lambda batch, a, b, p: tuple(_holds(s.value, p.anchor) for s in sets)


def facts_by_join(docs: DataFrame, by_anchor: DataFrame, width: int, span: int) -> DataFrame:
    """Documents -> doc_id, text, text_key, facts: the starts of their repeated paths, with what is known of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for a, b in W.slices(texts):
                p = paths_of(texts.slice(a, b - a).to_pylist(), width, span)
                row = pa.array(a + p.text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(2).take(row), _signed(p.anchor), pa.array(p.place.astype(np.int32))], ["p_doc_id", "p_key", "anchor", "start"]
                )

    rows = docs.select("doc_id", "text", text_key())
    paths = in_arrow(rows, run, "p_doc_id long, p_key long, anchor long, start int").join(by_anchor, "anchor")
    found = materialise(paths.groupBy("p_doc_id", "p_key").agg(F.collect_set(F.struct("start", "branches", "bound")).alias("facts")), "facts")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("p_doc_id")) & (F.col("text_key") == F.col("p_key"))).select("doc_id", "text", "text_key", "facts")


def joined_facts(batch: pa.RecordBatch, a: int, b: int, p: Paths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(3).slice(a, b - a)
    flat = lists.flatten()
    row = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy(zero_copy_only=False))
    known = (row << 32) + flat.field("start").to_numpy(zero_copy_only=False)
    order = np.argsort(known)
    known, own = known[order], (p.text.astype(np.int64) << 32) + p.place
    at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
    keep = known[at] == own if len(known) else np.zeros(len(own), bool)
    flag = lambda name: keep & flat.field(name).to_numpy(zero_copy_only=False)[order][at] if len(known) else keep
    return keep, flag("branches"), flag("bound")


def pieces(rows: DataFrame, facts: Facts, width: int, span: int) -> DataFrame:
    """Second pass: rows (doc_id, text, text_key, ...) -> the pieces that may repeat: d1, d2 (digest), doc_id, text_key, start, n_edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            texts = batch.column(1).cast(pa.binary())
            for a, b in W.slices(texts):
                p = paths_of(texts.slice(a, b - a).to_pylist(), width, span)
                keep, branch, bound = facts(batch, a, b, p)
                text, place, count, start, branch, bound = (x[keep] for x in (p.text, p.place, p.count, p.start, branch, bound))
                free = ~(branch | bound)
                # free neighbours are one piece
                goes_on = np.zeros(len(text), bool)
                goes_on[1:] = free[1:] & free[:-1] & (text[1:] == text[:-1]) & (place[:-1] + count[:-1] == place[1:])
                head = np.flatnonzero(~goes_on)
                total = np.add.reduceat(count, head) if len(head) else count
                whole = ~branch[head]
                # opened paths: one piece an edge
                sizes = count[branch]
                step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = np.concatenate([start[head][whole], np.repeat(start[branch], sizes) + step])
                edges = np.concatenate([total[whole], np.ones(len(step), np.int64)])
                number = np.concatenate([text[head][whole], np.repeat(text[branch], sizes)])
                data, at = p.words.joined()
                digests = b"".join([blake2b(data[i:j], digest_size=16).digest() for i, j in zip(at[first].tolist(), (at[first + edges + width - 1] - 1).tolist(), strict=True)])
                d = np.frombuffer(digests, np.int64).reshape(-1, 2)
                row = pa.array(a + number)
                columns = [pa.array(d[:, 0]), pa.array(d[:, 1]), ids.take(row), keys.take(row)]
                columns += [pa.array((first - p.words.first[number]).astype(np.int32)), pa.array(edges.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["d1", "d2", "doc_id", "text_key", "start", "n_edges"])

    return in_arrow(rows, run, "d1 long, d2 long, doc_id long, text_key long, start int, n_edges int")


def repeats(docs: DataFrame, width: int = WIDTH, span: int = SPAN, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents -> s_doc_id, s_key, spans: the pieces (start, n_edges) of each row that stand earlier in the corpus; written out."""
    by_anchor = anchors(docs, width, span)
    bits = bits_for(by_anchor.count())
    if bits <= max_bits:
        found = pieces(docs.select("doc_id", "text", text_key()), facts_by_sets(by_anchor, bits), width, span)
    else:
        found = pieces(facts_by_join(docs, by_anchor, width, span), joined_facts, width, span)
    found = materialise(found, "pieces")
    place = F.struct(F.col("doc_id"), F.col("start"))
    first = materialise(
        found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").select("d1", "d2", "first"),
        "first-places",
    )
    later = found.join(first, ["d1", "d2"]).filter(F.col("first") < place)
    # a text's own pieces, each once though rows repeat, so a row is no longer than its document
    spans = later.groupBy(F.col("doc_id").alias("s_doc_id"), F.col("text_key").alias("s_key")).agg(F.collect_set(F.struct("start", "n_edges")).alias("spans"))
    spans = materialise(spans, "spans")
    discard(by_anchor, found, first)
    return spans


def covered(n_words: int, start: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Marks of the words that windows from start on, ``count`` of them each, cover."""
    marks = np.zeros(n_words + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, np.minimum(start + count + width - 1, n_words), -1)
    return np.cumsum(marks[:-1]) > 0


def dedup(docs: DataFrame, width: int = WIDTH, span: int = SPAN, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents -> doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    Only texts of documents with repeats meet their spans in a join; a bit set tells them in place. A document that falls into it by
    chance takes part in the join and finds no spans. Where the set would be too large, all texts take part.
    """
    spans = repeats(docs, width, span, max_bits)
    hashed = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull(), F.xxhash64("text"))
    rows = docs.select("doc_id", "text", hashed.alias("place"))
    bits = bits_for(spans.count())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                kept = (text.as_py() or b"").split()
                n = len(kept)
                if spans.is_valid:
                    start, count = (spans.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n_edges"))
                    gone = covered(n, start, count, width)
                    kept = [w for w, g in zip(kept, gone.tolist(), strict=True) if not g]
                out.append((n, n - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    result = "doc_id long, n_words long, n_removed long, kept string"
    same = F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & (F.xxhash64("text") == F.col("s_key"))
    met = lambda some: some.join(spans, same, "left").select("doc_id", "text", "spans")
    if bits > max_bits:
        return in_arrow(met(rows.drop("place")), cut, result)
    place = F.xxhash64(F.coalesce("s_doc_id", F.lit(-1)), F.col("s_doc_id").isNull(), F.col("s_key"))
    has = docs.sparkSession.sparkContext.broadcast(bit_set(spans.select(place.alias("anchor")), bits))

    def part(repeating: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = _holds(has.value, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
                yield batch.filter(pa.array(held == repeating)).select(["doc_id", "text"])

        return in_arrow(rows, run, "doc_id long, text string")

    clean = part(False).withColumn("spans", F.lit(None).cast("array<struct<start:int,n_edges:int>>"))
    return in_arrow(met(part(True)), cut, result).unionByName(in_arrow(clean, cut, result))


def digest(deduplicated: DataFrame) -> DataFrame:
    """The contract's columns from ``dedup``."""
    return deduplicated.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
