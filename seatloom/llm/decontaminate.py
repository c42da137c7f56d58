"""Benchmark decontamination: a BM25 index of the test items, queried by every training document.

The index is built from the items; each document, whole, is a query of its distinct terms. Three entries stand for an item: the
item as a whole, its question and its answer. Block-max WAND retrieves every entry above its threshold. The threshold loses nothing: an
entry of S distinct shingles of which ``overlap`` must stand in the document can lack at most floor((1 - overlap) * S) of its terms,
since each missing term takes at least one shingle with it; its threshold is its full score less that many of its largest
impacts. Entries retrieved are verified on shingles of ``shingle`` words: an item is found in a document that holds ``overlap`` of the
item, of its question or of its answer; a question or an answer counts by itself from ``part_words`` words on.

An item's answer is its last sentence, its question what stands before; an item of one sentence is a question.

Items are held against documents in parts of at most ``items_per_part``; each part's index is sent to all tasks, so
what is broadcast has a fixed bound and a larger benchmark takes more passes. Statistics (number of items, mean length, document
frequencies) are those of all items.

Defined cases: null or empty items match nothing; an entry of fewer than ``shingle`` words is one shingle of all its
words; items that repeat are separate items; a null text matches nothing; rows of documents that repeat give a row each; rows of
one doc_id, or of none, are judged each by its own text; empty input gives empty output; other columns are ignored, or kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.llm import bm25
from seatloom.runtime import in_arrow, materialise

SHINGLE = 5
OVERLAP = 0.8
#: Least words of a question or an answer that is found without the rest of its item.
PART_WORDS = 10
ITEMS_PER_PART = 20_000
ENTRIES = ("item", "question", "answer")

_SENTENCE = re.compile(r"[.!?](?:\s+|$)")
RESULT = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double, found string"


def shingles(words: list[bytes], n: int) -> set[bytes]:
    """Distinct runs of ``n`` words; the whole sequence where there are fewer, none for no words."""
    if not words:
        return set()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    ends = [m.end() for m in _SENTENCE.finditer(text.rstrip())]
    cut = ends[-2] if len(ends) > 1 and ends[-1] >= len(text.rstrip()) else (ends[-1] if ends else 0)
    return (text[:cut], text[cut:]) if 0 < cut < len(text.rstrip()) else (text, "")


class ItemIndex:
    """Inverted index of test items, their questions and answers, with block maxima and retrieval thresholds.

    ``weights`` has the weight of each term, from the statistics of all items; ``mean_length`` is theirs, too.
    """

    def __init__(self, rows: list[tuple[int, str]], weights: dict[bytes, int], mean_length: float, shingle: int, overlap: float, part_words: int):
        self.overlap = overlap
        self.ids = [i for i, _ in rows]
        words = [[bm25.terms_of(p.encode()) for p in (t, *split_item(t))] for _, t in rows]
        #: for each item the shingles of its three entries
        self.sets = [[shingles(w, shingle) for w in three] for three in words]
        self.decides = [[True, len(three[1]) >= part_words, len(three[2]) >= part_words] for three in words]
        self.lengths = sorted({s.count(b" ") + 1 for three in self.sets for sets in three for s in sets})
        # an item of one sentence is its question: one entry of both
        entries = [(i, e) for i, three in enumerate(words) for e in range(3) if self.decides[i][e] and three[e] and (e == 0 or three[e] != three[0])]
        self.owner = np.array([i for i, _ in entries], np.int64)
        self.number: dict[bytes, int] = {}
        term, entry, tf = [], [], []
        for n, (i, e) in enumerate(entries):
            for t, count in Counter(words[i][e]).items():
                term.append(self.number.setdefault(t, len(self.number)))
                entry.append(n)
                tf.append(count)
        term, entry, tf = (np.array(x, np.int64) for x in (term, entry, tf))
        length = np.array([len(words[i][e]) for i, e in entries], float)
        self.weights = np.array([weights[t] for t in self.number], float)
        order = np.argsort(term, kind="stable")
        term, entry, tf = term[order], entry[order], tf[order]
        saturations = bm25.saturation(tf, length[entry], mean_length) if len(entry) else np.zeros(0)
        self.lists = bm25.Lists(np.bincount(term, minlength=len(self.number)), entry, saturations, len(entries))
        impacts = np.floor(self.weights[term] * saturations)
        by_entry = np.lexsort((impacts, entry))
        cuts = np.searchsorted(entry[by_entry], np.arange(len(entries) + 1))
        own = [impacts[by_entry[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]
        lack = [int((1 - overlap) * len(self.sets[i][e]) + 1e-9) for i, e in entries]
        self.thresholds = np.array([max(1.0, x[: max(0, len(x) - m)].sum()) for x, m in zip(own, lack, strict=True)])
        self.least = np.minimum.reduceat(self.thresholds, np.arange(0, len(entries), bm25.BLOCK)) if entries else self.thresholds
        #: term -> impact of whole items
        self.impacts: list[dict[bytes, float]] = [{} for _ in rows]
        names = list(self.number)
        for t, n, s in zip(term.tolist(), entry.tolist(), impacts.tolist(), strict=True):
            if entries[n][1] == 0:
                self.impacts[entries[n][0]][names[t]] = s

    def matches(self, text: bytes | None) -> list[tuple]:
        """(item, score as a share of the full score, overlap, question overlap, answer overlap, what was found) of all items verified."""
        words = bm25.terms_of(text)
        held = set(words)
        chosen = np.array([n for t in held if (n := self.number.get(t)) is not None], np.int64)
        if not len(chosen):
            return []
        entries, _ = bm25.above(self.lists, chosen, self.weights[chosen], self.thresholds, self.least)
        if not len(entries):
            return []
        items = np.unique(self.owner[entries]).tolist()
        wanted = set().union(*(s for i in items for s in self.sets[i]))
        own = {s for n in self.lengths for s in (b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) if s in wanted}
        out = []
        for i in items:
            shares = [len(s & own) / len(s) if s else 0.0 for s in self.sets[i]]
            found = [name for name, share, may in zip(ENTRIES, shares, self.decides[i], strict=True) if may and share >= self.overlap]
            if found:
                full = self.impacts[i]
                out.append((self.ids[i], sum(s for t, s in full.items() if t in held) / max(sum(full.values()), 1), *shares, ",".join(found)))
        return out


def leaks(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, overlap: float = OVERLAP, part_words: int = PART_WORDS, items_per_part: int = ITEMS_PER_PART
) -> DataFrame:
    """Documents and items -> one row for each document and item found in it: see RESULT.

    ``score`` is the document's BM25 score as a share of the item's full score, ``found`` names what was found: item, question, answer.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())] + [(n, pa.float64()) for n in ("score", "overlap", "question_overlap", "answer_overlap")] + [("found", pa.string())])

    def probe(sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                    found += [(doc_id, *m) for m in sent.value.matches(text.as_py())]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in found], schema)

        return in_arrow(docs.select("doc_id", "text"), run, RESULT)

    parts = [probe(index) for index in indexes(items, shingle, overlap, part_words, items_per_part)]
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], RESULT)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def indexes(items: DataFrame, shingle: int, overlap: float, part_words: int, items_per_part: int) -> list:
    """Broadcast indexes of the items, one for each part."""
    spark = items.sparkSession
    kept = items.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                counts = Counter(bm25.terms_of(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(counts), pa.int64()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["item_id", "term", "tf"]
                )

    # statistics of all items; of each part only its own terms come to the driver
    terms = materialise(in_arrow(kept, counted, "item_id long, term binary, tf long"), "item-terms")
    n, total = kept.count(), terms.agg(F.sum("tf")).first()[0] or 0
    frequency = materialise(terms.groupBy("term").agg(F.count("*").alias("df")), "item-frequencies")
    parts = -(-n // items_per_part)
    part_of = F.pmod(F.xxhash64("item_id"), F.lit(max(parts, 1)))
    out = []
    for part in range(parts):
        rows = [(r.item_id, r.text) for r in kept.filter(part_of == part).orderBy("item_id", "text").collect()]
        if rows:
            own = terms.filter(part_of == part).select("term").distinct().join(frequency, "term").toArrow()
            weights = dict(zip(own.column("term").to_pylist(), bm25.idf(n, own.column("df").to_numpy()).tolist(), strict=True))
            out.append(spark.sparkContext.broadcast(ItemIndex(rows, weights, max(total / n, 1.0), shingle, overlap, part_words)))
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, overlap: float = OVERLAP, part_words: int = PART_WORDS, items_per_part: int = ITEMS_PER_PART
) -> DataFrame:
    """Documents without those in which an item was found; all columns stay. Each row is judged where it is, by its own text."""
    at = docs.columns.index("text")
    for index in indexes(items, shingle, overlap, part_words, items_per_part):
        docs = in_arrow(docs, _without(index, at), docs.schema)
    return docs


def _without(index, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not index.value.matches(text.as_py()) for text in batch.column(at).cast(pa.binary())]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
