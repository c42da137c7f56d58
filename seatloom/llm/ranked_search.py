"""Ranked lexical search by sort-based accumulation: whole-number scores of all documents for each item.

Items are numbered in blocks of about ``block_terms`` (item, term) pairs, so what a block sends to the tasks is bounded; each block is one pass over the texts.

* Postings: a task turns its documents into chunks, one row each: the documents that hold a term of the block, and (document, term, frequency) arrays in
  document order. Number of documents, of their terms, and document frequencies are sums over all chunks.
* Accumulation: a task goes through its chunks in ranges of documents of about ``pairs`` (item, document, impact) triples. The triples of a range are concatenated,
  their packed keys (item, document) radix-sorted, and impacts of one key summed by ``reduceat``. All postings of a document are in its range, so sums never
  cross tasks; a heap for each item keeps the ``k`` best.
* Merge: the tasks' bests are range-partitioned by (item, score, document), so an item of many candidates spreads over ranges; each range
  heap-selects again, and the k best of what is left of an item are ranked.

Defined cases: documents are rows, those that repeat are separate; null and empty texts have no terms and are in no result; rows of one item_id
are one item, as are rows of null item_id; a term of an item counts once; items without terms or matches give no row; equal scores rank by doc_id, null first;
empty tables give an empty result; other columns are ignored. Numbers are 64-bit.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatloom.llm import bm25
from seatloom.runtime import in_arrow, materialise

K = 50
#: (item, term) pairs of a block, postings of a chunk, triples that are sorted at once.
BLOCK_TERMS, CHUNK, PAIRS = 500_000, 500_000, 1_000_000

CHUNKS = "n long, total long, terms array<int>, frequencies array<int>, ids binary, lengths binary, docs binary, numbers binary, tfs binary"
FOUND = "item_id long, doc_id long, score long"
#: Stands for a null id: it sorts before all others.
NO_ID = -(1 << 63)


def item_terms(items: DataFrame) -> DataFrame:
    """Items -> item_id, term, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                terms = sorted(set(bm25.terms_of(text.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([item_id] * len(terms), pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    return in_arrow(items.select("item_id", "text"), run, "item_id long, term binary").distinct()


class Block:
    """Some items: their ids, the numbers of their terms, and the items of each term one after another."""

    def __init__(self, rows: pa.Table):
        terms = rows.column("term").combine_chunks().dictionary_encode()
        self.vocabulary = {t: i for i, t in enumerate(terms.dictionary.to_pylist())}
        ids = rows.column("item_id").fill_null(NO_ID).to_numpy()
        self.ids, item = np.unique(ids, return_inverse=True)
        number = terms.indices.to_numpy()
        self.items = item[np.argsort(number, kind="stable")].astype(np.int64)
        self.sizes = np.bincount(number, minlength=len(self.vocabulary))
        self.stop = np.cumsum(self.sizes)
        self.start = self.stop - self.sizes


class Postings:
    """Gathers documents; ``batch`` gives the chunk's row and starts anew."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.n = self.total = self.size = 0
        self.ids, self.lengths, self.numbers, self.tfs = [], [], [], []

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.n, self.total = self.n + 1, self.total + len(words)
        held = [(self.vocabulary[t], c) for t, c in Counter(words).items() if t in self.vocabulary]
        if held:
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.lengths.append(len(words))
            pairs = np.array(held, np.int32)
            self.numbers.append(pairs[:, 0])
            self.tfs.append(pairs[:, 1])
            self.size += len(held)

    def batch(self) -> pa.RecordBatch:
        none = np.zeros(0, np.int32)
        numbers, tfs = np.concatenate([none, *self.numbers]), np.concatenate([none, *self.tfs])
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), [len(x) for x in self.numbers])
        counts = np.bincount(numbers, minlength=1)
        terms = np.flatnonzero(counts)
        blobs = [np.array(self.ids, np.int64), np.array(self.lengths, np.int64), docs, numbers, tfs]
        columns = [
            pa.array([self.n], pa.int64()),
            pa.array([self.total], pa.int64()),
            *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (terms, counts[terms])),
            *(pa.array([b.tobytes()], pa.binary()) for b in blobs),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, ["n", "total", "terms", "frequencies", "ids", "lengths", "docs", "numbers", "tfs"])


def postings(docs: DataFrame, block, chunk: int) -> DataFrame:
    """Documents and a broadcast block -> its chunks; written out, as statistics are needed before scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Postings(block.value.vocabulary)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                if words := bm25.terms_of(text.as_py()):
                    gathered.add(doc_id, words)
                    if gathered.size >= chunk:
                        yield gathered.batch()
        if gathered.n:
            yield gathered.batch()

    return materialise(in_arrow(docs.select("doc_id", "text"), run, CHUNKS), "postings")


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order that sorts unsigned keys, stable, by passes over digits of 16 bits from the lowest; only as many as the largest key has."""
    order = np.arange(len(keys))
    for shift in range(0, int(keys.max(initial=0)).bit_length(), 16):
        digit = ((keys[order] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def summed(keys: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's impacts."""
    if not len(keys):
        return keys, impacts
    order = radix_order(keys)
    keys, impacts = keys[order], impacts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(impacts, first)


class Heaps:
    """The k best (score, smaller document) of each item."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps, self.floor = k, [[] for _ in range(n)], np.zeros(n, np.int64)

    def add(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """Candidates with items ascending; those that can't be among the best are left before any goes into a heap."""
        hopeful = (scores > 0) & (scores >= self.floor[items])
        items, docs, scores = items[hopeful], docs[hopeful], scores[hopeful]
        bounds = np.append(np.flatnonzero(np.append(True, items[1:] != items[:-1])), len(items)) if len(items) else np.zeros(1, int)
        for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
            item, some, ids = items[start], scores[start:stop], docs[start:stop]
            if len(some) > self.k:
                keep = some >= np.partition(some, len(some) - self.k)[len(some) - self.k]
                some, ids = some[keep], ids[keep]
            heap = self.heaps[item]
            for entry in zip(some.tolist(), (-d for d in ids.tolist()), strict=True):
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = heap[0][0]

    def batch(self, ids: np.ndarray) -> pa.RecordBatch:
        items = np.repeat(ids, [len(h) for h in self.heaps])
        docs = np.array([-d for h in self.heaps for _, d in h], np.int64)
        scores = np.array([s for h in self.heaps for s, _ in h], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(items, mask=items == NO_ID), pa.array(docs, mask=docs == NO_ID), pa.array(scores)], ["item_id", "doc_id", "score"])


class Accumulator:
    """Scores the chunks of a task under a block's weights."""

    def __init__(self, block: Block, weights: np.ndarray, n: int, total: int, k: int, pairs: int):
        self.block, self.weights, self.n, self.total, self.pairs = block, weights, n, total, pairs
        self.heaps = Heaps(len(block.ids), k)

    def add(self, ids: np.ndarray, lengths: np.ndarray, docs: np.ndarray, numbers: np.ndarray, tfs: np.ndarray) -> None:
        block = self.block
        m = (50 + (50 * lengths * self.n) // self.total)[docs]
        tf = tfs.astype(np.int64)
        impacts = self.weights[numbers] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        upto = np.cumsum(block.sizes[numbers])
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))  # of each document
        before = upto[first] - block.sizes[numbers[first]]
        at = 0
        while at < len(first):
            stop = max(at + 1, int(np.searchsorted(before, before[at] + self.pairs, "right")) - 1)
            stop = len(first) if upto[-1] - before[at] <= self.pairs else stop
            self.range(slice(first[at], first[stop] if stop < len(first) else len(docs)), ids, docs, numbers, impacts)
            at = stop

    def range(self, part: slice, ids: np.ndarray, docs: np.ndarray, numbers: np.ndarray, impacts: np.ndarray) -> None:
        """All postings of some neighbouring documents."""
        block, docs, numbers = self.block, docs[part], numbers[part]
        low, width = int(docs[0]), np.uint64(int(docs[-1]) - int(docs[0]) + 1)
        items = block.items[bm25.spread(block.start[numbers], block.stop[numbers])].astype(np.uint64)
        times = block.sizes[numbers]
        keys = items * width + np.repeat((docs - low).astype(np.uint64), times)
        keys, scores = summed(keys, np.repeat(impacts[part], times))
        self.heaps.add((keys // width).astype(np.int64), ids[low + (keys % width).astype(np.int64)], scores)


def weights_of(chunks: DataFrame, block: Block, n: int) -> np.ndarray:
    """Each term's weight from its document frequency over all chunks; the block bounds how many there are."""
    counts = chunks.select(F.explode(F.arrays_zip("terms", "frequencies")).alias("c")).groupBy("c.terms").agg(F.sum("c.frequencies").alias("df")).toArrow()
    weights = np.zeros(len(block.vocabulary), np.int64)
    for number, df in zip(counts.column(0).to_pylist(), counts.column(1).to_pylist(), strict=True):
        weights[number] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return weights


def block_bests(docs: DataFrame, asked: DataFrame, k: int, chunk: int, pairs: int) -> DataFrame:
    """A block's rows (item_id, term) -> the k best documents of each item in each task; written out."""
    context = docs.sparkSession.sparkContext
    block = Block(asked.select("item_id", "term").toArrow())
    sent = context.broadcast(block)
    chunks = postings(docs, sent, chunk)
    n, total = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    weights = context.broadcast(weights_of(chunks, block, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accumulator = Accumulator(sent.value, weights.value, n, total, k, pairs)
        kinds = (np.int64, np.int64, np.int32, np.int32, np.int32)
        for batch in batches:
            for i in range(batch.num_rows):
                accumulator.add(*(np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, kinds, strict=True)))
        yield accumulator.heaps.batch(sent.value.ids)

    filled = chunks.filter("size(terms) > 0").select("ids", "lengths", "docs", "numbers", "tfs")
    return materialise(in_arrow(filled, run, FOUND), "bests")


def merged(found: DataFrame, k: int) -> DataFrame:
    """Bests of many tasks -> item_id, rank, doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            items, docs, scores = (rows.column(c).fill_null(NO_ID).to_numpy() for c in range(3))
            order = np.argsort(items, kind="stable")
            ids, number = np.unique(items[order], return_inverse=True)
            heaps = Heaps(len(ids), k)
            heaps.add(number, docs[order], scores[order])
            held = pa.Table.from_batches([heaps.batch(ids)])
        if held is not None:
            yield from held.to_batches()

    ranges = found.repartitionByRange(F.asc_nulls_first("item_id"), F.desc("score"), F.asc_nulls_first("doc_id"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = in_arrow(ranges, run, FOUND).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS, chunk: int = CHUNK, pairs: int = PAIRS) -> DataFrame:
    """Documents (doc_id, text) and items (item_id, text) -> item_id, rank, doc_id, score: the k best documents of each item."""
    asked = materialise(item_terms(items), "item-terms")
    blocks = max(1, -(-asked.count() // block_terms))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = [block_bests(docs, dealt.filter(F.col("block") == b), k, chunk, pairs) for b in range(blocks)]
    return merged(reduce(DataFrame.unionByName, found), k)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
l AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY ALL),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM p GROUP BY ALL), s),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM l, s),
f AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
