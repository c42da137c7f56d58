"""Near-dedup by word shingles: SimHash groups and MinHash bands propose, exact Jaccard decides, links are followed to components.

A document is the set of hashes of its runs of ``shingle`` words, as in ``simhash``, whose BK-trees give each document the group of its fingerprint. Fingerprints
of 64 bits can't find every pair of Jaccard 0.8: about ten bits differ there, often many more, and no cut into blocks that can be searched allows for that. So sets get,
besides the group, ``BANDS`` keys of ``ROWS`` least hashes each. A pair of Jaccard j shares no key with a chance of (1 - j**ROWS)**BANDS, at 0.8
less than one in a million. Unlike sets are kept apart by the keys' length, so one common line doesn't join documents.

Equal sets are one. Sets that share keys, directly or through others, form a family; within a family every pair is compared exactly
and links of a spanning forest stay. Large families are cut into chunks, and each two chunks meet in a group of their own. Only sets that
share a key travel.

Defined cases: as in ``simhash``; texts without words are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.llm import simhash
from seatloom.llm import words as W
from seatloom.llm.graph import components
from seatloom.llm.substring_dedup import MAX_BITS, _holds, bit_set, bits_for
from seatloom.runtime import discard, in_arrow, materialise

SHINGLE = 5
SIMILARITY = 0.8
#: Keys of a set, and least hashes of a key.
BANDS, ROWS = 50, 6
#: Most sets of one chunk, about.
CHUNK = 256

_FACTORS = W.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_PLACES = W.mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(simhash.shingle_hashes(text or b"", shingle))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of a set, different for different bands."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        mixed = W.mix(hashes)
        for at in range(0, len(mixed), 1024):
            # the product's high half depends on all bits of the hash
            block = mixed[at : at + 1024, None] * _FACTORS
            least = np.minimum(least, block.min(axis=0))
        return W.mix(W.mix(least.reshape(BANDS, ROWS) * _PLACES).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def prints_of(docs: DataFrame, shingle: int) -> DataFrame:
    """Documents with row_key -> doc_id, row_key, fp (hash of the whole set), bands, sim (the SimHash fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, bands, sims = np.zeros(batch.num_rows, np.uint64), np.zeros((batch.num_rows, BANDS), np.uint64), np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                every = simhash.shingle_hashes(text.as_py() or b"", shingle)
                hashes, sims[i] = np.unique(every), simhash.fingerprint(every)
                prints[i], bands[i] = xxhash.xxh64_intdigest(hashes.tobytes(), 7), band_keys(hashes)
            ends = pa.array(np.arange(0, batch.num_rows * BANDS + 1, BANDS, dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(bands.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64)), lists, pa.array(sims.view(np.int64))], ["doc_id", "row_key", "fp", "bands", "sim"])

    return in_arrow(docs.select("doc_id", "text", "row_key"), run, "doc_id long, row_key long, fp long, bands array<long>, sim long")


def near_pairs(names: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs of sets whose Jaccard similarity is at least ``similarity``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    joined, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    group, links = np.arange(len(sets)), []
    for i, own in enumerate(sets):
        low, count = np.searchsorted(joined, own, "left"), np.searchsorted(joined, own, "right")
        count = count - low
        spots = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(owner[spots], minlength=len(sets))
        for j in np.flatnonzero(common >= similarity * (sizes + sizes[i] - common) - 1e-9).tolist():
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                links.append((names[i], names[j]))
    return links


def near_links(docs: DataFrame, prints: DataFrame, shingle: int, similarity: float, chunk: int, max_bits: int) -> DataFrame:
    """Documents with row_key and their prints -> links (a, b) that connect all sets of at least ``similarity``."""
    spark = docs.sparkSession
    groups = simhash.component_roots(prints.select(F.col("sim").alias("fp")), simhash.RADIUS, simhash.LEAF)
    alike = prints.select("fp", "sim").distinct().join(groups, F.col("sim") == F.col("l_fp")).select("fp", F.xxhash64("root", F.lit("simhash")).alias("key"))
    keyed = materialise(prints.select("fp", F.explode("bands").alias("key")).distinct().unionByName(alike), "bands")
    shared = materialise(keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high").select("key", "low"), "shared-bands")
    families = components(keyed.join(shared, "key").filter("fp != low").select(F.col("fp").alias("a"), F.col("low").alias("b")))
    families = materialise(families.select(F.col("node").alias("fp"), F.col("component").alias("family")), "families")
    discard(keyed, shared)
    chunks = families.groupBy("family").count().select("family", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    # one document stands for each set
    one = prints.groupBy("fp").agg(F.min("row_key").alias("m_key"))
    members = materialise(families.join(chunks, "family").join(one, "fp"), "members")
    bits = bits_for(members.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if wanted is not None:
                batch = batch.filter(pa.array(_holds(wanted.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
            for a, b in W.slices(batch.column(1).cast(pa.binary())):
                sets = [shingle_set(t.as_py(), shingle).tobytes() for t in batch.column(1).slice(a, b - a).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.binary())], ["row_key", "hashes"])

    # a bit set of a checked size tells the members in place; where it would be too large they are joined
    wanted = spark.sparkContext.broadcast(bit_set(members.select(F.col("m_key").alias("anchor")), bits)) if bits <= max_bits else None
    texts = docs.select("row_key", "text")
    if wanted is None:
        texts = texts.join(members.select("m_key"), F.col("row_key") == F.col("m_key"), "left_semi")
    sets = in_arrow(texts, read, "row_key long, hashes binary")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("m_key", "fp", "family", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    held = materialise(sets, "sets")
    groups = held.join(met, F.col("row_key") == F.col("m_key")).select("family", "x", "y", "fp", "hashes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, found, out = None, {}, []

        def frame() -> pd.DataFrame:
            return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

        for pdf in batches:
            for family, x, y, fp, hashes in zip(*(pdf[c] for c in ("family", "x", "y", "fp", "hashes")), strict=True):
                if key != (family, x, y):
                    if len(found) > 1:
                        out += near_pairs(list(found), list(found.values()), similarity)
                    key, found = (family, x, y), {}
                found[fp] = np.frombuffer(hashes, np.uint64)
            if len(out) > 10_000:
                yield frame()
                out = []
        if len(found) > 1:
            out += near_pairs(list(found), list(found.values()), similarity)
        yield frame()

    keys = ["family", "x", "y"]
    return groups.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long")


def dedup(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, chunk: int = CHUNK, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents -> one row of each component, that of the least doc_id (null last); all columns stay."""
    keyed = docs.select("doc_id", "text", simhash.row_key().alias("row_key"))
    prints = materialise(prints_of(keyed, shingle), "prints")
    linked = materialise(components(near_links(keyed, prints, shingle, similarity, chunk, max_bits)), "linked")
    distinct = prints.select(F.col("fp").alias("l_fp")).distinct()
    roots = materialise(distinct.join(linked, F.col("l_fp") == F.col("node"), "left").select("l_fp", F.coalesce("component", "l_fp").alias("root")), "roots")
    return simhash.keep_first(docs, prints.select("doc_id", "fp", "row_key"), roots)
