"""Second-order gradient boosting: histogram trees on gradients and Hessians.

Every feature is cut into bins once. A tree grows level by level: each level is one aggregate over (node, feature,
bin), added up in the tasks and combined in Spark, and the driver picks the splits from it. Leaf values and gains
are regularised (``regLambda``, ``gamma``, ``minChildWeight``), rows are sampled per tree and columns per tree.

Of two nodes below a split only the lighter one is added up; the other one is what is left of
the node above.

The aggregate runs over a kept RDD of blocks of bin numbers: 900 levels of a model are 900 jobs, and a DataFrame
plan for each would cost several times the work of the level itself.
"""

from __future__ import annotations

import json
import threading
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.sources.staging import stage

BLOCK_ROWS = 1 << 16
TASK_ROWS = 1 << 17
_ODD = 0x9E3779B97F4A7C15
_RENEW = 25  # after so many trees the margins are worked out anew, so that their lineage stays short
_BATCHES = threading.Lock()  # models fitted side by side set the size of batches one after the other


@dataclass(frozen=True)
class Tree:
    """A complete binary tree in heap order; ``value`` has a number for every place of the last level.

    A node sends a row left if the bin of its feature is at most ``cut``. A node that was not split sends all rows
    left and has one value below it.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return int(np.log2(len(self.value)))

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` levels, counted from 0 within its level."""
        at, rows = np.zeros(bins.shape[1], dtype=np.int32), np.arange(bins.shape[1])
        for _ in range(levels):
            at = 2 * at + 1 + (bins[self.feature[at], rows] > self.cut[at])
        return at - ((1 << levels) - 1)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.place(bins, self.depth)]


@dataclass(frozen=True)
class Block:
    """Bins of some rows, one line per feature, their target, what the trees so far add up to, and a hash of each row."""

    bins: np.ndarray
    y: np.ndarray
    margin: np.ndarray
    mark: np.ndarray

    def plus(self, trees: list[Tree]) -> Block:
        margin = self.margin.copy()
        for tree in trees:
            margin += tree.margins(self.bins)
        return Block(self.bins, self.y, margin, self.mark)


def slopes(block: Block, poisson: bool) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the loss in the margin: squared error, or Poisson deviance of exp(margin)."""
    if poisson:
        mean = np.exp(np.minimum(block.margin, 30.0))
        return mean - block.y, mean
    return block.margin - block.y, np.ones(len(block.y))


def sampled(block: Block, rate: float, seed: int) -> np.ndarray:
    """The rows of a block that a tree learns from, by a hash of row and seed: however the rows are dealt, and
    whenever a task runs again, they are the same. Equal rows go together."""
    if rate >= 1:
        return np.arange(len(block.y))
    drawn = _mixed(block.mark + np.uint64((seed * _ODD) % (1 << 64)))
    return np.flatnonzero(drawn < np.uint64(int(rate * (1 << 63)) * 2))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number changes every bit of the result."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def histogram(
    blocks, tree: Tree, level: int, slots: np.ndarray, columns: np.ndarray, sizes: np.ndarray, poisson: bool, rate: float, seed: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums of gradients and Hessians for the blocks of one task: a line per slot, the bins of all columns in it.

    ``slots`` gives each node of the level its line, -1 for those that are not asked for; ``sizes`` is the number of
    bins of each column. The Hessian of the squared error is a count of rows.
    """
    n, width = int(slots.max()) + 1, int(sizes.sum())
    starts = np.cumsum(sizes) - sizes
    g_sum, h_sum = np.zeros((n, width)), np.zeros((n, width), dtype=np.float64 if poisson else np.int64)
    for block in blocks:
        rows = sampled(block, rate, seed)
        line = slots[tree.place(block.bins, level)[rows]]
        rows, line = rows[line >= 0], line[line >= 0].astype(np.int64)
        g, h = (x[rows] for x in slopes(block, poisson))
        for column, start, size in zip(columns, starts, sizes, strict=True):
            at = line * size + block.bins[column][rows]
            g_sum[:, start : start + size] += np.bincount(at, g, n * size).reshape(n, size)
            h_sum[:, start : start + size] += np.bincount(at, h if poisson else None, n * size).reshape(n, size)
    return [(g_sum, h_sum if poisson else h_sum.astype(np.int32) if h_sum.max(initial=0) < 1 << 31 else h_sum)]


def added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    wide = np.float64 if b[1].dtype == np.float64 else np.int64
    return a[0] + b[0], a[1].astype(wide) + b[1]


def level_sums(found: tuple[np.ndarray, np.ndarray], asked: np.ndarray, above: np.ndarray | None, nodes: int, sizes: np.ndarray) -> np.ndarray:
    """Sums over (node, column, bin) for a whole level. Of two nodes below a split the one asked for has been added
    up; the other one is what is left of the node above. Nodes below no split have zeros."""
    n_bins = int(sizes.max())
    total = np.zeros((2, nodes, len(sizes), n_bins))
    place = np.concatenate([i * n_bins + np.arange(size) for i, size in enumerate(sizes)])
    flat = total.reshape(2, nodes, -1)
    for i in range(2):
        flat[i][np.ix_(asked, place)] = found[i]
    if above is not None:
        flat[:, asked ^ 1] = above.reshape(2, nodes // 2, -1)[:, asked >> 1] - flat[:, asked]
        np.maximum(flat[1], 0, out=flat[1])
    return total


def best_splits(sums: np.ndarray, reg_lambda: float, gamma: float, min_child: float) -> tuple[np.ndarray, ...]:
    """Per node: gain, column and cut of its best split, and the sums left and right of it.

    Of equal gains the first column and the lowest cut win.
    """
    g, h = sums
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    all_g, all_h = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_g**2 / (left_h + reg_lambda) + right_g**2 / (right_h + reg_lambda) - all_g**2 / (all_h + reg_lambda)) / 2 - gamma
    gain[(left_h < min_child) | (right_h < min_child) | ~np.isfinite(gain)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    column, cut = np.divmod(best, gain.shape[2])
    node = np.arange(len(gain))
    return flat[node, best], column, cut, *(x[node, column, cut] for x in (left_g, left_h, right_g, right_h))


def grow(blocks: RDD, columns: np.ndarray, depth: int, sizes: np.ndarray, rate: float, seed: int, settings: dict, poisson: bool) -> Tree:
    """One tree; a job per level. ``sizes`` is the number of bins of every feature."""
    n, n_bins = (1 << depth) - 1, int(sizes.max())
    feature, cut = np.zeros(n, dtype=np.int32), np.full(n, n_bins, dtype=np.int32)
    value = np.zeros(1 << depth)
    reg, few = settings["regLambda"], blocks.getNumPartitions() <= 16
    alive, asked, sums = np.array([True]), np.array([0]), None
    for level in range(depth):
        tree = Tree(feature, cut, value)
        slots = np.full(1 << level, -1, dtype=np.int32)
        slots[asked] = np.arange(len(asked))
        work = partial(histogram, tree=tree, level=level, slots=slots, columns=columns, sizes=sizes[columns], poisson=poisson, rate=rate, seed=seed)
        parts = blocks.mapPartitions(work)
        # many tasks' sums are combined in further tasks, so that the driver gets a few
        found = reduce(added, parts.collect()) if few else parts.treeReduce(added, depth=2)
        sums = level_sums(found, asked, sums, 1 << level, sizes[columns])
        gain, column, at, lg, lh, rg, rh = best_splits(sums, reg, settings["gamma"], settings["minChildWeight"])
        split = alive & (gain > 0)
        base, width = (1 << level) - 1, 1 << (depth - level)
        if level == 0:
            value[:] = _leaf(sums[0, 0, 0].sum(), sums[1, 0, 0].sum(), reg)
        for node in np.flatnonzero(split):
            feature[base + node], cut[base + node] = columns[column[node]], at[node]
            middle = node * width + width // 2
            value[node * width : middle] = _leaf(lg[node], lh[node], reg)
            value[middle : (node + 1) * width] = _leaf(rg[node], rh[node], reg)
        alive = np.repeat(split, 2)
        if not alive.any():
            break
        nodes = np.flatnonzero(split)
        asked = 2 * nodes + (rh < lh)[nodes]  # the lighter of the two nodes below
    return Tree(feature, cut, value * settings["stepSize"])


def _leaf(g: float, h: float, reg_lambda: float) -> float:
    return -g / (h + reg_lambda) if h + reg_lambda > 0 else 0.0


def few_values(vectors: DataFrame, size: int, most: int) -> dict[int, np.ndarray]:
    """The values of each feature that has ``most`` of them at most, in order. A task tells no more than that of each."""

    def work(batches):
        seen: list[np.ndarray | None] = [np.zeros(0)] * size
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            for i in range(size):
                if seen[i] is not None:
                    values = np.union1d(seen[i], x[:, i])
                    seen[i] = values if len(values) <= most else None
        rows = [(i, float(v)) for i, values in enumerate(seen) if values is not None for v in values]
        rows += [(i, None) for i, values in enumerate(seen) if values is None]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64())], names=["i", "v"])

    told = vectors.select("x").mapInArrow(work, "i int, v double")
    each = told.groupBy("i").agg(F.max(F.col("v").isNull()).alias("many"), F.collect_set("v").alias("values"))
    found = each.where(~F.col("many") & (F.size("values") <= most)).collect()
    return {r["i"]: np.array(sorted(r["values"]), dtype=np.float64) for r in found}


def bin_edges(vectors: DataFrame, max_bins: int) -> list[np.ndarray]:
    """Per feature the upper edges of all bins but the last: every value if there are few, however rare, else quantiles."""
    size = len(vectors.first()["x"])
    few = few_values(vectors, size, max_bins)
    edges = {i: values[: max(1, len(values) - 1)] for i, values in few.items()}
    shares = [float((i + 1) / max_bins) for i in range(max_bins - 1)]
    # one row per feature, with as many numbers as bins
    wanted = [F.percentile_approx(F.col("x")[i], F.array(*map(F.lit, shares)), 10 * max_bins).alias(f"q{i}") for i in range(size) if i not in few]
    if wanted:
        row = vectors.agg(*wanted).first()
        edges |= {i: np.unique(np.array(row[f"q{i}"], dtype=np.float64)) for i in range(size) if i not in few}
    return [edges[i] for i in range(size)]


def to_blocks(vectors: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Rows as blocks of bin numbers, a byte per value; 256 bins at most."""

    def work(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy().reshape(n, -1)
            bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
            y = batch.column("y").to_numpy()
            yield pa.record_batch([pa.array([bins.tobytes()]), pa.array([y.tobytes()])], names=["bins", "y"])

    return vectors.mapInArrow(work, "bins binary, y binary")


def _load(row, features: int, margin: float) -> Block:
    y = np.frombuffer(row["y"], dtype=np.float64)
    bins = np.frombuffer(row["bins"], dtype=np.uint8).reshape(features, -1)
    mark = y.view(np.uint64)
    for line in bins:
        mark = (mark ^ line) * np.uint64(_ODD)
    return Block(bins, y, np.full(len(y), margin), mark)


def blocks_of(vectors: DataFrame, edges: list[np.ndarray], margin: float, rows: int | None = None) -> RDD:
    """The rows of ``vectors`` as a kept RDD of blocks, in as many tasks as there are cores. If their number ``rows`` is
    told, in no more tasks than have ``TASK_ROWS`` each: starting a task takes longer than adding up fewer."""
    spark = vectors.sparkSession
    with _BATCHES:
        batch_rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
        try:
            stored = stage(to_blocks(vectors, edges), "blocks")
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    tasks = spark.sparkContext.defaultParallelism
    if rows is not None:
        tasks = min(tasks, -(-rows // TASK_ROWS))
    found = stored.rdd.getNumPartitions()
    if found < tasks:
        stored = stored.repartition(tasks)
    elif found > tasks:  # the driver gets sums from every task of every level
        stored = stored.coalesce(tasks)
    return stored.rdd.map(partial(_load, features=len(edges), margin=margin)).persist(StorageLevel.MEMORY_AND_DISK)


def fit_trees(vectors: DataFrame, settings: dict) -> dict:
    """Fit on ``x`` (array of double, no nulls) and ``y``; returns the model as plain lists."""
    poisson = settings["objective"] == "poisson"
    edges = bin_edges(vectors, settings["maxBins"])
    sizes = np.array([len(e) + 1 for e in edges])
    mean, rows = vectors.agg(F.avg("y"), F.count("*")).first()
    start = float(np.log(max(mean, 1e-6))) if poisson else mean
    plain = blocks_of(vectors, edges, start, rows)
    rng = np.random.default_rng(settings["seed"])
    n_columns = max(1, int(settings["columnRate"] * len(edges)))
    trees: list[Tree] = []
    now = old = plain
    try:
        for number in range(settings["maxIter"]):
            columns = np.sort(rng.choice(len(edges), n_columns, replace=False))
            seed = settings["seed"] + number
            tree = grow(now, columns, settings["maxDepth"], sizes, settings["subsamplingRate"], seed, settings, poisson)
            trees.append(tree)
            if old is not plain and old is not now:
                old.unpersist()  # the blocks that came from it are kept by now
            old = now
            if len(trees) % _RENEW:
                now = old.map(partial(Block.plus, trees=[tree])).persist(StorageLevel.MEMORY_AND_DISK)
            else:
                now = plain.map(partial(Block.plus, trees=list(trees))).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for kept in (now, old, plain):
            kept.unpersist()
    return {
        "start": start,
        "poisson": poisson,
        "trees": [
            {
                "feature": t.feature.tolist(),
                "threshold": [_threshold(edges[f], c) for f, c in zip(t.feature, t.cut, strict=True)],
                "value": t.value.tolist(),
            }
            for t in trees
        ],
    }


def _threshold(edges: np.ndarray, cut: int) -> float:
    return float(edges[cut]) if cut < len(edges) else float("inf")


def predict_rows(model: dict, x: np.ndarray) -> np.ndarray:
    """Predictions for rows of plain feature values."""
    out = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for tree in model["trees"]:
        feature, threshold = np.array(tree["feature"], dtype=np.int64), np.array(tree["threshold"])
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(np.log2(len(tree["value"])))):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        out += np.array(tree["value"])[at - len(feature)]
    return np.exp(np.minimum(out, 30.0)) if model["poisson"] else out


class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model; its trees are a parameter, so it is saved with a pipeline."""

    def __init__(self, features_col: str = "features", prediction_col: str = "prediction", model: dict | None = None) -> None:
        super().__init__()
        self.trees = Param(self, "trees", "start and trees as JSON", TypeConverters.toString)
        self._set(featuresCol=features_col, predictionCol=prediction_col)
        if model is not None:
            self._set(trees=json.dumps(model))

    def model(self) -> dict:
        return json.loads(self.getOrDefault("trees"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.model()

        @F.pandas_udf("double")
        def predicted(x: pd.Series) -> pd.Series:
            return pd.Series(predict_rows(model, np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Gradient boosting with regularised second-order trees.

    ``objective`` is "squared" or "poisson". ``columnRate`` of the columns and ``subsamplingRate`` of the rows are
    drawn for each tree. Feature vectors must hold no missing values. An empty table cannot be fitted.
    """

    _DEFAULTS = {
        "maxIter": 150, "stepSize": 0.08, "maxDepth": 6, "subsamplingRate": 0.85, "columnRate": 0.85, "maxBins": 64,
        "regLambda": 1.0, "gamma": 0.0, "minChildWeight": 1.0, "seed": 42, "objective": "squared",
    }

    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", **settings):
        super().__init__()
        unknown = set(settings) - set(self._DEFAULTS)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        self._settings = {**self._DEFAULTS, **settings}
        if not 2 <= self._settings["maxBins"] <= 256:
            raise ValueError("maxBins must lie between 2 and 256")
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        label = F.col(self.getLabelCol()).cast("double").alias("y")
        vectors = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), label)
        return BoostedTreesModel(self.getFeaturesCol(), self.getPredictionCol(), fit_trees(vectors, self._settings))

