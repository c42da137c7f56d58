"""SimHash near-dedup: fingerprints, BK-trees in shards, connected components.

Texts are lower-cased (A-Z), cut into words, and all runs of ``shingle`` words are hashed with XXH64
(seed 42); a fingerprint bit is set where over half the hashes have it. Documents whose fingerprints
differ in at most ``radius`` bits are linked; links are followed to components.

Work is on distinct fingerprints, so a group of exact copies is one of them. The 64 bits are cut into
m > radius blocks. Two fingerprints within the radius agree in at least m - radius blocks, so each choice of so many blocks with
their values is a shard that can be searched by itself. m grows with the number of fingerprints (4 blocks up to 16 million, 5 up to
5 billion), so a shard of unlike fingerprints keeps its size. A shard's fingerprints form BK-trees: the children
of a node are keyed by their Hamming distance to it, and a search at distance d only follows the keys from d - radius
to d + radius. Shards hold at most ``leaf`` fingerprints a tree; a larger one is cut into several trees
and all fingerprints of the shard are searched in each of them, tree by tree in separate groups. A group gives
a spanning forest of its links, never all pairs.

Trees are built where their shard's rows are, not broadcast: together they are as large as the corpus's fingerprints.

Defined cases: fewer than ``shingle`` words give one shingle of all words; no words, or null, give
fingerprint zero, which is linked like any other; rows that repeat are separate documents; a null doc_id keeps its
row and does not name a component unless all its members are null; empty input gives empty output;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm import columns as C
from seatloom.llm.graph import components
from seatloom.runtime import discard, in_arrow, materialise, ship

SHINGLE = 3
RADIUS = 3
#: Most fingerprints of one BK-tree, and wanted for a shard.
LEAF, SHARD = 1024, 256

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; of all words where there are fewer."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    places = zip(starts[: len(parts) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
    return np.array([digest(joined[a:b], 42) for a, b in places], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes, as an unsigned number."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        block = hashes[at : at + (1 << 14)]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # sums of up to 255 rows fit a byte
        for b in range(0, len(bits), 255):
            ones += bits[b : b + 255].sum(axis=0, dtype=np.uint8)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > n).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keys: str) -> DataFrame:
    """Documents -> doc_id, fp (the fingerprint's 64 bits as a long) and further columns of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out = np.zeros(len(texts), np.uint64)
            for i, text in enumerate(texts):
                out[i] = fingerprint(shingle_hashes(text.as_py() or b"", shingle))
            more = [batch.column(2 + i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64)), *more], ["doc_id", "fp", *keys])

    return in_arrow(docs.select("doc_id", "text", *keys), run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keys)))


class BkTree:
    """Fingerprints keyed below their parent by integer Hamming distance."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def near(self, value: int, radius: int) -> Iterator[int]:
        """All members within the radius."""
        stack = [self.root] if self.root else []
        while stack:
            other, children = stack.pop()
            d = (other ^ value).bit_count()
            if d <= radius:
                yield other
            for key, child in children.items():
                if d - radius <= key <= d + radius:
                    stack.append(child)


def spanning_links(members: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: members form the tree, queries (and members) are searched in it."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    links, tree = [], BkTree()

    def search(x: int) -> None:
        for y in tree.near(x, radius):
            a, b = find(x), find(y)
            if a != b:
                parent[a] = b
                links.append((x, y))

    for m in members:
        search(m)
        tree.add(m)
    for q in queries:
        search(q)
    return links


def masks(n: int, radius: int, shard: int = SHARD) -> list[int]:
    """Bits by which n fingerprints are put into shards, a mask for each choice of blocks; fingerprints within the radius agree under one of them."""
    m = radius + 1
    while m < 16 and n / 2 ** (64 * (m - radius) / m) > shard:
        m += 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(m), m - radius)]


def near_links(distinct: DataFrame, radius: int = RADIUS, leaf: int = LEAF, shard: int = SHARD) -> DataFrame:
    """Distinct fingerprints (fp), written out -> links (a, b) that connect all fingerprints within the radius."""
    ship(distinct.sparkSession)
    under = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    shards = [F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(under(mask))).alias("value")) for i, mask in enumerate(masks(distinct.count(), radius, shard))]
    placed = distinct.select("fp", F.explode(F.array(*shards)).alias("shard")).select("fp", "shard.block", "shard.value")
    sizes = placed.groupBy("block", "value").count().filter("count > 1").withColumn("trees", F.ceil(F.col("count") / leaf).cast("int"))
    sizes = materialise(sizes.select("block", "value", "trees"), "shards")
    # a fingerprint is a member of one tree of its shard and is searched in the later ones
    own = F.when(F.col("trees") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("fp", "block"), F.col("trees")).cast("int"))
    groups = (
        placed.join(sizes, ["block", "value"])
        .withColumn("own", own)
        .select("block", "value", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"), "trees")
        # searches in a tree are spread: the tree's members go to every part
        .withColumn("parts", F.greatest(F.lit(1), F.col("trees") - F.col("tree") - 1))
        .withColumn(
            "part",
            F.explode(
                F.when(F.col("own") == F.col("tree"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.col("own") - F.col("tree") - 1))
            ),
        )
        .select("block", "value", "tree", "part", "fp", (F.col("own") == F.col("tree")).alias("member"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, members, queries, out = None, [], [], []
        for pdf in batches:
            rows = zip(pdf["block"], pdf["value"], pdf["tree"], pdf["part"], pdf["fp"], pdf["member"], strict=True)
            for block, value, tree, part, fp, member in rows:
                if key != (block, value, tree, part):
                    out += spanning_links(members, queries, radius)
                    key, members, queries = (block, value, tree, part), [], []
                (members if member else queries).append(fp & 0xFFFFFFFFFFFFFFFF)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b"], dtype=np.uint64).astype(np.int64)
                out = []
        out += spanning_links(members, queries, radius)
        yield pd.DataFrame(out, columns=["a", "b"], dtype=np.uint64).astype(np.int64)

    keys = ["block", "value", "tree", "part"]
    return groups.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long")


def component_roots(prints: DataFrame, radius: int, leaf: int, shard: int = SHARD) -> DataFrame:
    """Fingerprints (fp) -> l_fp, root: the least fingerprint of its component, a row for each distinct one."""
    distinct = materialise(prints.select("fp").distinct(), "distinct-fingerprints")
    linked = components(near_links(distinct, radius, leaf, shard))
    rooted = distinct.join(linked, F.col("fp") == F.col("node"), "left")
    return materialise(rooted.select(F.col("fp").alias("l_fp"), F.coalesce("component", "fp").alias("root")), "roots")


def clusters(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, leaf: int = LEAF, shard: int = SHARD) -> DataFrame:
    """Documents -> doc_id, fp, component_id (least doc_id of the component)."""
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    roots = component_roots(prints, radius, leaf, shard)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = materialise(roots.join(least, F.col("l_fp") == F.col("fp")).groupBy("root").agg(F.min("least").alias("component_id")), "components")
    labels = materialise(roots.join(named, "root").select("l_fp", "component_id"), "labels")
    discard(roots, named)
    return prints.join(labels, F.col("fp") == F.col("l_fp"), "left").select("doc_id", "fp", "component_id")


def digest(clustered: DataFrame) -> DataFrame:
    """The contract's columns from ``clusters``."""
    return clustered.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """Tells rows apart; rows alike in doc_id and text are one document where it is used."""
    return F.xxhash64(doc_id, text, F.lit(1))


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Documents -> one row of each component, that of the least doc_id (null last); all columns stay.

    Rows are told apart by a hash of doc_id and text; rows alike in both are one document here.
    """
    prints = materialise(fingerprints(docs.select("doc_id", "text", row_key().alias("row_key")), shingle, "row_key"), "fingerprints")
    return keep_first(docs, prints, component_roots(prints, radius, leaf))


def keep_first(docs: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """Documents, their prints (doc_id, fp, row_key) and components (l_fp, root) -> the row of least doc_id of each component."""
    rooted = prints.join(roots, F.col("fp") == F.col("l_fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_key"))
    kept = materialise(rooted.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.row_key").alias("kept_key")), "kept")
    dropped = materialise(prints.join(kept, F.col("row_key") == F.col("kept_key"), "left_anti").select(F.col("row_key").alias("gone_key")).distinct(), "dropped")
    # the documents' own columns are hidden, so none clashes with a key
    hidden, key = C.hidden(docs), row_key(C.own("doc_id"), C.own("text"))
    rows = hidden.join(dropped, key == F.col("gone_key"), "left_anti")
    # kept rows that repeat: only these few are dealt by key
    twice = prints.join(kept, F.col("row_key") == F.col("kept_key"), "left_semi").groupBy("row_key").count().filter("count > 1")
    twice = materialise(twice.select(F.col("row_key").alias("twice_key")), "repeated")
    discard(kept)
    single = rows.join(twice, key == F.col("twice_key"), "left_anti")
    repeated = rows.join(twice, key == F.col("twice_key"), "left_semi").withColumn("dedup_key", key).dropDuplicates(["dedup_key"]).drop("dedup_key")
    return C.shown(single.unionByName(repeated), docs.columns)
