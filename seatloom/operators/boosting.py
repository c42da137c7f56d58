"""Gradient boosting of symmetric trees on tables of any size: histograms by partial aggregation, one pass over binned rows a level.

* Features: numbers are cut into at most ``bins`` bins (all values where there are few, else quantiles); categories become ordered target statistics:
  the mean label of the *earlier* rows of a random order that have the category, drawn to the overall mean; rows are dealt once by that order, in ranges. Rows to be scored take the statistics of all training rows.
* A tree asks one (feature, bin) a level, the same in all nodes. A pass gives each task's sums of gradients for (node, feature, bin), Spark adds them up, and
  the driver picks the split of largest gain: ``2**depth * features * bins`` numbers at most, whatever the rows.
* The rows' scores are folded into the written table every ``refresh`` trees; passes in between evaluate the trees since then.
* Losses: squared, logistic, and quantile, whose leaves are exact quantiles of the residuals. Rows marked ``valid`` stop training after ``patience`` trees
  without a better loss and cut the model to the best one; their loss comes with the next tree's first pass.
* Slices of neighbouring trees tell how sure a prediction is.

Null and NaN numbers are a bin of their own, below all others; a null category is a category; rows of null label are left out of training.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from seatloom.operators import ranks
from seatloom.runtime import in_arrow, materialise

STATE = "b_row long, b_bins binary, b_y double, b_valid boolean, b_raw double"
#: Cells that carry the summed loss and the number of rows.
LOSS, VALID_LOSS = -1, -2
#: About so many rows of a range of ordered statistics, so a task's memory does not grow with the table.
ROWS = 100_000


@dataclass
class Params:
    loss: str = "squared"
    trees: int = 1000
    depth: int = 10
    rate: float = 0.1
    l2: float = 5.0
    bins: int = 64
    alpha: float = 0.5
    patience: int = 50
    prior: float = 1.0
    refresh: int = 16

    def __post_init__(self) -> None:
        if self.loss not in ("squared", "logistic", "quantile"):
            raise ValueError(f"unknown loss: {self.loss}")
        if not 2 <= self.bins <= 250:
            raise ValueError("bins must be 2 to 250")


@dataclass
class Tree:
    features: list[int]
    thresholds: list[int]
    leaves: list[float]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        return leaf_of(bins, self.features, self.thresholds)

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.leaves)[self.leaf_of(bins)]


def leaf_of(bins: np.ndarray, features: list[int], thresholds: list[int]) -> np.ndarray:
    leaf = np.zeros(len(bins), np.int64)
    for level, (f, t) in enumerate(zip(features, thresholds, strict=True)):
        leaf |= (bins[:, f] > t).astype(np.int64) << level
    return leaf


def gradients(loss: str, alpha: float, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second derivative of each row's loss, and the loss."""
    if loss == "logistic":
        p = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
        return p - y, p * (1 - p), np.logaddexp(0, raw) - y * raw
    if loss == "quantile":
        over = raw > y
        return np.where(over, 1 - alpha, -alpha), np.ones(len(y)), np.where(over, (1 - alpha) * (raw - y), alpha * (y - raw))
    return raw - y, np.ones(len(y)), (raw - y) ** 2


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Numbers to bins: 0 for missing, else one more than the number of cuts below."""
    out = np.zeros(values.shape, np.uint8)
    for f, c in enumerate(cuts):
        known = ~np.isnan(values[:, f])
        out[known, f] = np.searchsorted(c, values[known, f], "left") + 1
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long lists of doubles; nulls inside are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def packed(bins: np.ndarray) -> pa.Array:
    """Rows of bins as a binary column."""
    n, width = bins.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1]), pa.py_buffer(np.ascontiguousarray(bins))])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of rows of bins, none of them null, as a matrix over the same memory."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8, len(column) * width, first).reshape(-1, width)


def best_split(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[int, int, float]:
    """Sums by (node, feature, bin) -> feature, threshold and gain of the best split of all nodes; the first of equals."""
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    all_g, all_h = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
    score = lambda a, b: a * a / (b + l2)
    with np.errstate(invalid="ignore", divide="ignore"):
        gains = np.nan_to_num(score(left_g, left_h)) + np.nan_to_num(score(all_g - left_g, all_h - left_h)) - np.nan_to_num(score(all_g, all_h))
    gains = gains.sum(axis=0)
    f, t = np.unravel_index(int(np.argmax(np.round(gains, 9))), gains.shape)
    return int(f), int(t), float(gains[f, t])


def long_form(rows: DataFrame, categorical: list[str], columns: list[str]) -> DataFrame:
    """One row for each row's category: ``columns``, feature, category."""
    return rows.select(*columns, F.posexplode(F.array(*[F.col(c).cast("string") for c in categorical])).alias("feature", "category"))


def smoothed(total: Column, n: Column, mean: float, prior: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + mean * prior) / (F.coalesce(n, F.lit(0)) + prior)


def ordered_statistics(
    rows: DataFrame, row: str, order: list[str | Column], categorical: list[str], label: str, mean: float, prior: float, keep: tuple[str, ...] = (), ranges: int | None = None
) -> DataFrame:
    """Training rows -> row, ``keep``, ``stats``: each category's mean label over the rows before it in ``order``, drawn to ``mean`` by ``prior`` rows of it.

    Rows are cut into ranges by ``order``, one for each ``ROWS`` rows if left out. What the ranges before one hold of its categories, a row for each, meets its rows,
    which are gone through in order; so a row is dealt whole and not once for each category, and a hot category is spread.
    """
    width, by = len(categorical), [F.asc_nulls_first(c) for c in order]
    ranges = ranges or max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS))
    placed = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("s_at", F.monotonically_increasing_id())  # a partition's number and a place in it
    own = [F.col(c).cast("string").alias(f"s_{i}") for i, c in enumerate(categorical)]
    dealt = materialise(placed.select(row, *keep, F.col(label).cast("double").alias("s_y"), *own, "s_at", F.shiftright("s_at", 33).cast("int").alias("s_range")), "ordered-rows")
    sums = long_form(dealt, [f"s_{i}" for i in range(width)], ["s_range", "s_y"]).groupBy("s_range", "feature", "category").agg(F.sum("s_y").alias("total"), F.count("*").alias("n"))
    before = Window.partitionBy("feature", "category").orderBy("s_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    carried = sums.select("s_range", "feature", "category", F.sum("total").over(before).alias("total"), F.sum("n").over(before).alias("n"))
    schema = dealt.select(row, *keep).schema.add("stats", ArrayType(DoubleType()))
    names = [row, *keep]

    def run(found: pa.Table, earlier: pa.Table) -> pa.Table:
        found = found.take(pc.sort_indices(found, [("s_at", "ascending")])).combine_chunks()
        y = found.column("s_y").fill_null(0.0).to_numpy().astype(np.longdouble)  # sums of all rows, of which single categories' are told
        feature, stats = earlier.column("feature").to_numpy(), np.empty((found.num_rows, width))
        for f in range(width):
            told = earlier.filter(pa.array(feature == f))
            codes = pc.dictionary_encode(found.column(f"s_{f}").combine_chunks(), null_encoding="encode")
            at = pc.index_in(codes.dictionary, told.column("category").combine_chunks()).to_numpy()
            base, seen = (told.column(c).fill_null(0).to_numpy()[at] for c in ("total", "n"))
            code = codes.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            group, sorted_y = code[order], y[order]
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            upto = np.cumsum(sorted_y) - sorted_y
            sizes = np.diff(np.append(head, len(group)))
            total = base[group] + (upto - np.repeat(upto[head], sizes))
            n = seen[group] + np.arange(len(group)) - np.repeat(head, sizes)
            stats[order, f] = (total + mean * prior) / (n + prior)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, max(width, 1)), pa.int32()), pa.array(stats.ravel()))
        return pa.table([*(found.column(c) for c in names), lists], [*names, "stats"])

    return dealt.groupBy("s_range").cogroup(carried.groupBy("s_range")).applyInArrow(run, schema)


def by_row(values: DataFrame, row: str) -> DataFrame:
    """Rows (row, feature, value) -> row, ``stats`` by feature. They are dealt as numbers, before lists are made of them."""
    return values.repartition(row).groupBy(row).agg(F.array_sort(F.collect_list(F.struct("feature", "value")))["value"].alias("stats"))


def known_statistics(rows: DataFrame, row: str, categorical: list[str], totals: DataFrame, mean: float, prior: float) -> DataFrame:
    """Rows -> row, ``stats`` from the training rows' totals (feature, category, total, n)."""
    each = long_form(rows, categorical, [row])
    known = totals.select(F.col("feature").alias("t_feature"), F.col("category").alias("t_category"), "total", "n")
    same = (F.col("feature") == F.col("t_feature")) & F.col("category").eqNullSafe(F.col("t_category"))
    return by_row(each.join(known, same, "left").select(row, "feature", smoothed(F.col("total"), F.col("n"), mean, prior).alias("value")), row)


@dataclass
class Model:
    """Trees with what turns rows into bins. ``totals``: labels by category of the training rows."""

    numeric: list[str]
    categorical: list[str]
    params: Params
    base: float = 0.0
    mean: float = 0.0
    cuts: list[list[float]] = field(default_factory=list)
    trees: list[Tree] = field(default_factory=list)
    losses: list[tuple[float, float]] = field(default_factory=list)
    totals: DataFrame | None = None

    def raw(self, bins: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Sum of some trees; the base belongs to the first."""
        out = np.full(len(bins), self.base if first == 0 else 0.0)
        for tree in self.trees[first:last]:
            out += tree.scores(bins)
        return out

    def slices(self, n: int = 10) -> list[tuple[int, int]]:
        """At most n runs of equally many neighbouring trees; what is left over at the end is in none."""
        width = max(1, len(self.trees) // n)
        return [(i * width, min((i + 1) * width, len(self.trees))) for i in range(n) if i * width < len(self.trees)]

    def features(self, rows: DataFrame, row: str) -> DataFrame:
        """Rows with ``b_values``: their numbers, then the statistics of their categories."""
        numbers = [F.col(c).cast("double") for c in self.numeric]
        if not self.categorical:
            return rows.withColumn("b_values", F.array(*numbers))
        stats = known_statistics(rows, row, self.categorical, self.totals, self.mean, self.params.prior)
        return rows.join(stats, row).withColumn("b_values", F.concat(F.array(*numbers).cast("array<double>"), "stats")).drop("stats")

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with ``prediction`` (a probability for the logistic loss) and ``uncertainty``, the deviation of the slices' sums."""
        tagged = rows if not self.categorical else materialise(rows.withColumn("b_row", F.monotonically_increasing_id()), "to-score")
        valued = self.features(tagged, "b_row")
        cuts, width, slices, logistic = [np.array(c) for c in self.cuts], len(self.cuts), self.slices(), self.params.loss == "logistic"
        light = Model(self.numeric, self.categorical, self.params, self.base, self.mean, self.cuts, self.trees)
        sent = rows.sparkSession.sparkContext.broadcast(light)  # bounded by the parameters

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index("b_values")
                bins = binned(matrix(batch.column(at), width), cuts)
                raw = sent.value.raw(bins)
                parts = np.array([sent.value.raw(bins, *s) for s in slices]) if slices else np.zeros((1, len(bins)))
                columns = [c for i, c in enumerate(batch.columns) if i != at]
                names = [n for i, n in enumerate(batch.schema.names) if i != at]
                shown = 1 / (1 + np.exp(-np.clip(raw, -500, 500))) if logistic else raw
                yield pa.RecordBatch.from_arrays([*columns, pa.array(shown), pa.array(parts.std(axis=0))], [*names, "prediction", "uncertainty"])

        schema = valued.drop("b_values").schema.add("prediction", "double").add("uncertainty", "double")
        return in_arrow(valued, run, schema).select(*rows.columns, "prediction", "uncertainty")

    def save(self, folder: str, spark: SparkSession) -> None:
        told = {k: v for k, v in self.__dict__.items() if k not in ("totals", "params", "trees")}
        told |= {"params": asdict(self.params), "trees": [asdict(t) for t in self.trees]}
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/model")
        if self.totals is not None:
            self.totals.write.mode("overwrite").parquet(f"{folder}/totals")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Model:
        told = json.loads(spark.read.text(f"{folder}/model").first().value)
        trees, params = [Tree(**t) for t in told.pop("trees")], Params(**told.pop("params"))
        model = Model(params=params, trees=trees, **told)
        model.totals = spark.read.parquet(f"{folder}/totals") if model.categorical else None
        return model


def cut_points(rows: DataFrame, width: int, bins: int) -> list[list[float]]:
    """For each place of ``b_values``: all values but the largest where there are at most ``bins``, else the values at so many equal shares."""
    at = lambda i: F.nanvl(F.get("b_values", F.lit(i)), F.lit(None).cast("double"))
    shares = [i / bins for i in range(1, bins)]
    n = rows.agg(*[F.approx_count_distinct(at(i)).alias(f"f{i}") for i in range(width)]).first()
    few = [i for i in range(width) if n[i] <= 2 * bins]
    values: dict[int, set[float]] = {i: set() for i in few}
    if few:
        # some hundreds of values a feature
        for r in rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), at(i).alias("v")) for i in few])).alias("x")).select("x.*").filter("v IS NOT NULL").distinct().collect():
            values[r.i].add(r.v)
    # shares are asked only where there are many values
    many = [i for i in range(width) if i not in values or len(values[i]) > bins]
    told = dict(zip(many, rows.agg(*[F.percentile_approx(at(i), shares, 100 * bins) for i in many]).first(), strict=True)) if many else {}
    return [sorted(set(told[i] or [])) if i in told else sorted(values[i])[:-1] for i in range(width)]


def histograms(state: DataFrame, model: Model, folded: int, splits: tuple[list[int], list[int]], valid: bool) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[float, float]]]:
    """One pass: sums of both derivatives by (node, feature, bin), and the mean losses."""
    params, width, depth = model.params, len(model.cuts), len(splits[0])
    n_bins = params.bins + 2
    fresh = Model([], [], params, trees=model.trees[folded:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << depth) * width * n_bins
        g, h, told = np.zeros(size), np.zeros(size), {LOSS: [0.0, 0.0], VALID_LOSS: [0.0, 0.0]}
        for batch in batches:
            bins = unpacked(batch.column(0), width)
            y, held, raw = (c.to_numpy(zero_copy_only=False) for c in batch.columns[1:4])
            raw = raw + fresh.raw(bins)
            first, second, loss = gradients(params.loss, params.alpha, raw, y)
            for cell, rows in ((LOSS, ~held), (VALID_LOSS, held)):
                told[cell][0] += loss[rows].sum()
                told[cell][1] += rows.sum()
            own, first, second = bins[~held], first[~held], second[~held]
            leaf = leaf_of(own, *splits) * (width * n_bins)
            for f in range(width):
                cell = leaf + own[:, f]
                most = size - f * n_bins
                g[f * n_bins :] += np.bincount(cell, first, most)
                h[f * n_bins :] += np.bincount(cell, second, most)
        some = np.flatnonzero(h)
        cells = np.concatenate([some, list(told)])
        sums = [np.concatenate([x[some], [t[i] for t in told.values()]]) for i, x in enumerate((g, h))]
        yield pa.RecordBatch.from_arrays([pa.array(cells), *map(pa.array, sums)], ["cell", "g", "h"])

    rows = state if valid else state.filter("NOT b_valid")
    summed = in_arrow(rows.select("b_bins", "b_y", "b_valid", "b_raw"), run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    cells, sums = summed.column("cell").to_numpy(), [summed.column(c).to_numpy() for c in ("g", "h")]
    out = [np.zeros((1 << depth) * width * n_bins) for _ in sums]
    for o, s in zip(out, sums, strict=True):
        o[cells[cells >= 0]] = s[cells >= 0]
    losses = {int(c): (a / n if n else math.nan, n) for c, a, n in zip(cells[cells < 0], *(s[cells < 0] for s in sums), strict=True)}
    return *(o.reshape(1 << depth, width, n_bins) for o in out), losses


def with_scores(state: DataFrame, model: Model, folded: int) -> DataFrame:
    """The state with the trees from ``folded`` on added to ``b_raw``."""
    width, fresh = len(model.cuts), Model([], [], model.params, trees=model.trees[folded:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = unpacked(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(batch.column(4).to_numpy() + fresh.raw(bins))], batch.schema.names)

    return in_arrow(state, run, STATE)


def residual_quantiles(state: DataFrame, model: Model, folded: int, tree: Tree) -> list[float]:
    """Exact quantiles of the residuals in a tree's leaves; 0 for an empty leaf."""
    width = len(model.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = unpacked(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaf_of(bins)), pa.array(batch.column(2).to_numpy() - batch.column(4).to_numpy())], ["leaf", "residual"])

    left = in_arrow(with_scores(state, model, folded).filter("NOT b_valid"), run, "leaf long, residual double")
    out = [0.0] * (1 << len(tree.features))
    for r in ranks.quantiles(left, ["leaf"], "residual", [model.params.alpha]).collect():
        out[r.leaf] = r.q[0]
    return out


def grow(state: DataFrame, model: Model, folded: int, valid: bool) -> tuple[Tree, dict[int, tuple[float, float]]]:
    """The next tree, and the losses before it."""
    params, splits, first = model.params, ([], []), {}
    while True:
        level = len(splits[0])
        g, h, losses = histograms(state, model, folded, splits, valid and level == 0)
        first = first or losses
        f, t, gain = best_split(g, h, params.l2)
        if gain <= 1e-9:
            sums = g[:, 0, :].sum(axis=1), h[:, 0, :].sum(axis=1)
            break
        splits[0].append(f)
        splits[1].append(t)
        if level + 1 == params.depth:
            # a leaf's number has the answer to the last question as its highest bit
            sums = tuple(np.concatenate([x[:, f, : t + 1].sum(axis=1), x[:, f, t + 1 :].sum(axis=1)]) for x in (g, h))
            break
    with np.errstate(invalid="ignore", divide="ignore"):
        leaves = np.nan_to_num(-sums[0] / (sums[1] + params.l2))
    tree = Tree(*splits, leaves.tolist())
    if params.loss == "quantile" and splits[0]:
        tree.leaves = residual_quantiles(state, model, folded, tree)
    tree.leaves = [params.rate * x for x in tree.leaves]
    return tree, first


def prepared(rows: DataFrame, model: Model, label: str, valid: Column | None) -> DataFrame:
    """Training rows as bins; sets the model's base, statistics and cuts. Written out."""
    params = model.params
    mark = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(False)
    columns = {**{c: F.col(c) for c in (*model.numeric, *model.categorical)}, "b_y": F.col(label).cast("double"), "b_valid": mark}
    tagged = rows.select(*[c.alias(n) for n, c in columns.items()]).filter("b_y IS NOT NULL AND NOT isnan(b_y)")
    tagged = materialise(tagged.withColumn("b_row", F.monotonically_increasing_id()), "training-rows")
    train = tagged.filter("NOT b_valid")
    stats = train.agg(F.avg("b_y").alias("mean"), F.count("*").alias("n")).first()
    if not stats.n:
        raise ValueError("no rows to train on")
    model.mean = stats.mean
    if params.loss == "logistic":
        p = min(max(stats.mean, 1e-6), 1 - 1e-6)
        model.base = math.log(p / (1 - p))
    else:
        model.base = stats.mean if params.loss == "squared" else ranks.quantiles(train, [], "b_y", [params.alpha]).first().q[0]
    if model.categorical:
        model.totals = materialise(long_form(train, model.categorical, ["b_y"]).groupBy("feature", "category").agg(F.sum("b_y").alias("total"), F.count("*").alias("n")), "category-totals", scoped=False)
        # a random order of rows that does not change between reads
        order = [F.md5(F.col("b_row").cast("string")), "b_row"]
        numbers = F.array(*[F.col(c).cast("double") for c in model.numeric]).cast("array<double>")
        kept = ("b_y", "b_valid", "b_numbers")
        known = ordered_statistics(train.withColumn("b_numbers", numbers), "b_row", order, model.categorical, "b_y", model.mean, params.prior, kept)
        if valid is not None:
            held = tagged.filter("b_valid")
            held_stats = known_statistics(held, "b_row", model.categorical, model.totals, model.mean, params.prior)
            known = known.unionByName(held.select("b_row", "b_y", "b_valid", numbers.alias("b_numbers")).join(held_stats, "b_row"))
        valued = materialise(known.select("b_row", "b_y", "b_valid", F.concat("b_numbers", "stats").alias("b_values")), "training-values")
    else:
        valued = model.features(tagged, "b_row").select("b_row", "b_y", "b_valid", "b_values")
    width = len(model.numeric) + len(model.categorical)
    model.cuts = cut_points(valued.filter("NOT b_valid"), width, params.bins)
    cuts, base = [np.array(c) for c in model.cuts], model.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned(matrix(batch.column(3), width), cuts)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(bins), batch.column(1), batch.column(2), pa.array(np.full(len(bins), base))], ["b_row", "b_bins", "b_y", "b_valid", "b_raw"])

    return materialise(in_arrow(valued, run, STATE), "boosting-state")


def fit(rows: DataFrame, numeric: list[str], categorical: list[str], label: str, params: Params | None = None, valid: Column | None = None) -> Model:
    """Rows -> a model of ``label``; rows in which ``valid`` holds decide when to stop and train nothing."""
    model = Model(list(numeric), list(categorical), params or Params())
    params = model.params
    state, folded, best = prepared(rows, model, label, valid), 0, (math.inf, 0)

    def better(losses: dict[int, tuple[float, float]]) -> bool:
        """Note the losses of the trees so far; false once they have not been better for too long."""
        nonlocal best
        held = losses.get(VALID_LOSS, (math.nan, 0))[0]
        model.losses.append((losses[LOSS][0], held))
        if held < best[0]:
            best = held, len(model.trees)
        return valid is None or math.isnan(held) or len(model.trees) - best[1] < params.patience

    while len(model.trees) < params.trees:
        tree, losses = grow(state, model, folded, valid is not None)
        if not better(losses) or not tree.features:
            break
        model.trees.append(tree)
        if len(model.trees) - folded >= params.refresh:
            state, folded = materialise(with_scores(state, model, folded), "boosting-state"), len(model.trees)
    else:
        better(histograms(state, model, folded, ([], []), valid is not None)[2])
    if valid is not None and math.isfinite(best[0]):
        model.trees = model.trees[: best[1]]
    return model
