"""Random forest of regression trees on binned features.

All trees grow at once. The wide nodes at their tops are split level by level: a task adds up (node, feature, bin) for
its blocks, the sums of a tree meet in one task that picks its splits, and the driver gets the splits alone. A node with
few rows is handed over instead: its rows go to one task, which grows what is below it. So no task holds more than a
bounded number of rows of a node, and the sums of the many nodes far down are never sent.
"""

from __future__ import annotations

import base64
import io
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.boosting import _ODD, Block, Tree, _mixed, best_splits, bin_edges, blocks_of, level_sums

HANDED_ROWS = 1 << 14  # a node of so many drawn rows at most is grown in one task
_SUMS = 1 << 22  # numbers of gradients, and of rows, that a task adds up at once
_TASK_ROWS = 1 << 20  # drawn rows handed to one task, of many nodes
_POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 15)]))[:14]
_POISSON = np.array([int(p * (1 << 53)) << 11 for p in _POISSON], dtype=np.uint64)


def draws(block: Block, seed: int | None) -> np.ndarray:
    """How often a tree draws each row, Poisson with mean 1, from a hash of row and seed; once each without a seed.

    Rows that are equal in all bins and the target are drawn alike."""
    if seed is None:
        return np.ones(len(block.y), dtype=np.uint8)
    number = _mixed(block.mark + np.uint64((seed * _ODD) % (1 << 64)))
    return np.searchsorted(_POISSON, number, side="right").astype(np.uint8)


def add_up(bins: np.ndarray, line: np.ndarray, wy: np.ndarray, weight: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Sums of target and weight per line and bin: two tables with a row per line, the bins of all columns in it."""
    total, start = np.empty((2, n, int(sizes.sum()))), 0
    for column, size in zip(bins, sizes, strict=True):
        at = line * size + column
        total[0, :, start : start + size] = np.bincount(at, wy, n * size).reshape(n, size)
        total[1, :, start : start + size] = np.bincount(at, weight, n * size).reshape(n, size)
        start += size
    return total


def picked(sums: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node: gain, column and cut of its best split, and the sums left and right of it."""
    n = sums.shape[1]
    return best_splits(level_sums(sums, np.arange(n), None, n, sizes), 0.0, 0.0, 1.0)


class Growing:
    """A tree that is being grown: what it has so far, its open nodes of the present level, and nodes handed over."""

    def __init__(self, depth: int, n_bins: int) -> None:
        n = (1 << depth) - 1
        self.tree = Tree(np.zeros(n, dtype=np.int32), np.full(n, n_bins, dtype=np.int32), np.zeros(1 << depth))
        self.open, self.handed = np.array([0]), []

    def split(self, level: int, found: tuple[np.ndarray, ...]) -> None:
        tree, depth, still = self.tree, self.tree.depth, []
        base, width = (1 << level) - 1, 1 << (depth - level)
        for node, gain, column, at, lg, lh, rg, rh in zip(self.open, *found, strict=True):
            if level == 0:
                tree.value[:] = (lg + rg) / (lh + rh) if lh + rh else 0.0
            if not gain > 0:
                continue
            tree.feature[base + node], tree.cut[base + node] = column, at
            for side, g, h in ((0, lg, lh), (1, rg, rh)):
                child = 2 * node + side
                tree.value[child * width // 2 : (child + 1) * width // 2] = g / h
                if level + 1 < depth and h > HANDED_ROWS:
                    still.append(child)
                elif level + 1 < depth and h > 1:
                    self.handed.append((level + 1, child, h))
        self.open = np.array(still, dtype=np.int64)

    def put(self, level: int, node: int, below: Tree) -> None:
        """Set what was grown below a node into its place."""
        depth, inner = self.tree.depth, below.depth
        width = 1 << inner
        self.tree.value[node * width : (node + 1) * width] = below.value
        for k in range(inner):
            to, source = (1 << (level + k)) - 1 + (node << k), (1 << k) - 1
            self.tree.feature[to : to + (1 << k)] = below.feature[source : source + (1 << k)]
            self.tree.cut[to : to + (1 << k)] = below.cut[source : source + (1 << k)]
        assert level + inner == depth


def top_sums(blocks: Iterator[Block], trees: dict, level: int, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per tree the sums of its open nodes over the blocks of a task. ``trees`` has the seed of the draws, the tree and
    a line for each node of the level, -1 for those that are not open."""
    sums: dict[int, np.ndarray] = {}
    for block in blocks:
        for number, (seed, tree, lines) in trees.items():
            weight = draws(block, seed)
            line = lines[tree.place(block.bins, level)]
            rows = np.flatnonzero((line >= 0) & (weight > 0))
            weight = weight[rows].astype(np.float64)
            found = add_up(block.bins[:, rows], line[rows], weight * block.y[rows], weight, int(lines.max()) + 1, sizes)
            sums[number] = sums[number] + found if number in sums else found
    yield from sums.items()


def hand_over(blocks: Iterator[Block], trees: dict, level: int) -> Iterator[tuple]:
    """The drawn rows of the nodes handed over, by the number of the node. ``trees`` has the seed of the draws, the tree
    and for each node of the level the number of the node handed over that it lies in, else -1."""
    for block in blocks:
        for seed, tree, numbers in trees.values():
            weight = draws(block, seed)
            number = numbers[tree.place(block.bins, level)]
            rows = np.flatnonzero((number >= 0) & (weight > 0))
            rows = rows[np.argsort(number[rows], kind="stable")]
            found, start = np.unique(number[rows], return_index=True)
            bins, y, weight = block.bins[:, rows], block.y[rows], weight[rows]
            for key, a, z in zip(found, start, [*start[1:], len(rows)], strict=True):
                yield int(key), (bins[:, a:z], y[a:z], weight[a:z])


def grown_below(pieces: Iterator[tuple], levels: np.ndarray, depth: int, sizes: np.ndarray) -> Iterator[tuple[int, Tree]]:
    """What is below the nodes handed to a task; ``levels`` tells how far down each of them is."""
    nodes: dict[int, list] = defaultdict(list)
    for key, piece in pieces:
        nodes[key].append(piece)
    for key, parts in nodes.items():
        bins, y, weight = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
        yield key, grow_here(bins, y, weight.astype(np.float64), depth - int(levels[key]), sizes)


def grow_here(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, sizes: np.ndarray) -> Tree:
    """A tree from rows in hand. Of two nodes below a split the one with fewer rows is added up."""
    growing = Growing(depth, int(sizes.max()))
    tree, wy = growing.tree, weight * y
    tree.value[:] = wy.sum() / weight.sum()
    at, nodes = np.zeros(len(y), dtype=np.int64), np.array([0])  # the open node of each row; places of the open nodes
    sums = add_up(bins, at, wy, weight, 1, sizes)
    for level in range(depth):
        gain, column, cut, lg, lh, rg, rh = picked(sums, sizes)
        good = np.flatnonzero(gain > 0)
        if not len(good):
            break
        base, width = (1 << level) - 1, 1 << (depth - level - 1)
        tree.feature[base + nodes[good]], tree.cut[base + nodes[good]] = column[good], cut[good]
        below = np.stack([2 * nodes[good], 2 * nodes[good] + 1], axis=1).ravel()
        values = np.stack([lg[good] / lh[good], rg[good] / rh[good]], axis=1).ravel()
        tree.value.reshape(-1, width)[below] = values[:, None]
        if level + 1 == depth:
            break
        line = np.full(len(nodes), -1)
        line[good] = np.arange(len(good))
        rows = np.flatnonzero(line[at] >= 0)
        side = bins[column[at[rows]], rows] > cut[at[rows]]
        at = 2 * line[at[rows]] + side
        bins, wy, weight = bins[:, rows], wy[rows], weight[rows]
        light = (rh < lh)[good]
        few = np.flatnonzero(side == light[at >> 1])
        told = add_up(bins[:, few], at[few] >> 1, wy[few], weight[few], len(good), sizes)
        both = np.empty((2, len(good), 2, told.shape[2]))
        i = np.arange(len(good))
        both[:, i, light.astype(int)] = told
        both[:, i, 1 - light.astype(int)] = sums[:, good] - told
        sums, nodes = both.reshape(2, 2 * len(good), -1), below
    return tree


def in_parts(trees: dict[int, Growing], width: int) -> Iterator[dict[int, Growing]]:
    """Trees with open nodes, so many at once that the sums of a task stay small."""
    part, size = {}, 0
    for number, growing in trees.items():
        if not len(growing.open):
            continue
        if part and size + len(growing.open) * width > _SUMS:
            yield part
            part, size = {}, 0
        part[number], size = growing, size + len(growing.open) * width
    if part:
        yield part


def grow_forest(blocks: RDD, sizes: np.ndarray, n_trees: int, depth: int, seeds: list[int | None]) -> list[Tree]:
    tasks, trees = blocks.getNumPartitions(), {i: Growing(depth, int(sizes.max())) for i in range(n_trees)}
    level = 0
    while level < depth and any(len(t.open) for t in trees.values()):
        for part in in_parts(trees, int(sizes.sum())):
            asked = {}
            for number, growing in part.items():
                lines = np.full(1 << level, -1)
                lines[growing.open] = np.arange(len(growing.open))
                asked[number] = (seeds[number], growing.tree, lines)
            sums = blocks.mapPartitions(partial(top_sums, trees=asked, level=level, sizes=sizes))
            met = sums.reduceByKey(np.add, min(tasks, len(part)), partitionFunc=int)
            for number, found in met.mapValues(partial(picked, sizes=sizes)).collect():
                part[number].split(level, found)
        level += 1
    places = [(number, *node) for number, growing in trees.items() for node in growing.handed]
    if places:
        given = {number: (seeds[number], growing.tree, np.full(1 << level, -1)) for number, growing in trees.items()}
        for key, (number, above, node, _) in enumerate(places):
            given[number][2][node << (level - above)] = key  # rows of a node that is not split stay on its left
        n = max(tasks, int(sum(p[3] for p in places)) // _TASK_ROWS + 1)
        handed = blocks.mapPartitions(partial(hand_over, trees=given, level=level)).partitionBy(n, partitionFunc=int)
        levels = np.array([p[1] for p in places])
        for key, below in handed.mapPartitions(partial(grown_below, levels=levels, depth=depth, sizes=sizes)).collect():
            number, above, node, _ = places[key]
            trees[number].put(above, node, below)
    return [growing.tree for growing in trees.values()]


def fit_forest(vectors: DataFrame, settings: dict) -> dict[str, np.ndarray]:
    """Fit on ``x`` (array of double, no nulls) and ``y``; returns one table per part of the trees, a row per tree."""
    edges = bin_edges(vectors, settings["maxBins"])
    sizes = np.array([len(e) + 1 for e in edges])
    first = settings["seed"]
    seeds = [first + i if settings["bootstrap"] else None for i in range(settings["numTrees"])]
    blocks = blocks_of(vectors, edges, 0.0)
    try:
        trees = grow_forest(blocks, sizes, settings["numTrees"], settings["maxDepth"], seeds)
    finally:
        blocks.unpersist()
    upper = np.full((len(edges), int(sizes.max()) + 1), np.inf)
    for i, values in enumerate(edges):
        upper[i, : len(values)] = values
    feature, cut = (np.stack([getattr(t, name) for t in trees]) for name in ("feature", "cut"))
    return {"feature": feature, "threshold": upper[feature, cut], "value": np.stack([t.value for t in trees])}


def forest_rows(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Predictions for rows of plain feature values: the mean over the trees."""
    out, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, value in zip(forest["feature"], forest["threshold"], forest["value"], strict=True):
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(np.log2(len(value)))):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        out += value[at - len(feature)]
    return out / len(forest["value"])


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted forest; its trees are a parameter, so it is saved with a pipeline."""

    def __init__(self, features_col: str = "features", prediction_col: str = "prediction", forest: dict | None = None) -> None:
        super().__init__()
        self.trees = Param(self, "trees", "tables of the trees, packed", TypeConverters.toString)
        self._set(featuresCol=features_col, predictionCol=prediction_col)
        if forest is not None:
            packed = io.BytesIO()
            np.savez_compressed(packed, **forest)
            self._set(trees=base64.b64encode(packed.getvalue()).decode())

    def forest(self) -> dict[str, np.ndarray]:
        with np.load(io.BytesIO(base64.b64decode(self.getOrDefault("trees")))) as packed:
            return {name: packed[name] for name in packed.files}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = self.forest()

        @F.pandas_udf("double")
        def predicted(x: pd.Series) -> pd.Series:
            return pd.Series(forest_rows(forest, np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))


class Forest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Random forest regression with all features at each split, as the reference has it.

    Each tree draws the rows with replacement (``bootstrap``). Feature vectors must hold no missing values. An empty
    table cannot be fitted.
    """

    _DEFAULTS = {"numTrees": 100, "maxDepth": 12, "maxBins": 64, "bootstrap": True, "seed": 42}

    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", **settings):
        super().__init__()
        unknown = set(settings) - set(self._DEFAULTS)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        self._settings = {**self._DEFAULTS, **settings}
        if not 2 <= self._settings["maxBins"] <= 256:
            raise ValueError("maxBins must lie between 2 and 256")
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        label = F.col(self.getLabelCol()).cast("double").alias("y")
        vectors = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), label)
        return ForestModel(self.getFeaturesCol(), self.getPredictionCol(), fit_forest(vectors, self._settings))
