"""Hard-negative mining with R-trees packed by sort-tile-recursive (STR).

Rows are ranged into shards by label and by slabs of the widest coordinates. A directory holds the bounding box
and the labels of every shard. For an anchor ``q`` a box gives an interval of inner products, coordinate by
coordinate; an anchor is sent only to shards whose interval and labels can matter to it. Each shard becomes one
packed R-tree, and the anchors sent there stream past it: a queue per anchor opens the node of the highest bound
first and leaves out nodes that lie outside the score window or strictly below the k-th score so far.

This is done twice: for an anchor's positives (same label, any score), then for the negatives of each positive
(other labels, a window of scores below the positive's).
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.sources.staging import stage

_FOUND = "anchor long, slot int, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    """``k`` positives and negatives; a negative scores at least ``percent`` of its positive and no more than it.

    Shards hold ``shard_rows`` rows, or fewer in a table that has too few for all tasks, down to ``least_rows``.
    ``sample_rows`` bounds the rows that choose the slabs; what is found does not depend on them.
    """

    k: int = 5
    percent: int = 80
    shard_rows: int = 32768
    least_rows: int = 2048
    page_shards: int = 512
    salt_anchors: int = 1024
    leaf: int = 64
    fan: int = 8
    sample_rows: int = 10_000
    coordinates: int = 2
    slabs: int = 16


def whole_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label`` and ``vec``: each component times ``scale``, rounded down; equal rows count once.

    Left out are rows with a null id, label or vector, an empty vector, or a component that is null or not finite.
    """
    x = F.col("embedding").cast("array<double>")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    rows = rows.where("vec_id is not null and label is not null").where(F.coalesce(fine, F.lit(False)) & (F.size("x") > 0))
    vec = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    return rows.select("vec_id", "label", vec.alias("vec")).distinct().withColumn("dim", F.size("vec"))


# --- the tree of one shard -------------------------------------------------------------------------------------


def str_order(keys: np.ndarray, leaf: int) -> np.ndarray:
    """Sort-tile-recursive: an order of the rows of ``keys`` in which every ``leaf`` rows are a page.

    Rows are sorted by the first column and cut into slabs, each slab by the next column, and so on; with ``p``
    pages and ``k`` columns left there are ``p ** (1 / k)`` slabs.
    """
    out = []
    todo = [(np.arange(len(keys)), 0)]
    while todo:
        rows, column = todo.pop()
        pages, left = -(-len(rows) // leaf), keys.shape[1] - column
        if not left or pages <= 1:
            out.append(rows)
            continue
        rows = rows[np.argsort(keys[rows, column], kind="stable")]
        slabs = max(1, ceil(pages ** (1 / left) - 1e-9))
        step = -(-pages // slabs) * leaf  # whole pages
        todo += [(rows[at : at + step], column + 1) for at in range(0, len(rows), step)][::-1]
    return np.concatenate(out)


class Tree:
    """A packed R-tree: pages of ``leaf`` rows, then nodes of ``fan`` neighbours each, up to one root.

    Node ``i`` spans the labels ``least[i]`` to ``most[i]`` and the box ``low[i]`` to ``high[i]``; its children
    are ``first[i]`` to ``last[i]``, which are rows if ``i < pages``, else nodes.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, settings: Settings) -> None:
        wide = np.argsort(-(high.max(axis=0) - low.min(axis=0)), kind="stable")
        wide = wide[: max(1, int(np.ceil(np.log2(max(2, len(ids) / settings.leaf)))))]
        order = str_order(np.column_stack([labels, low[:, wide] + high[:, wide]]), settings.leaf)
        self.ids, self.labels, self.rows, self.tops, self.least_label = ids[order], labels[order], low[order], high[order], least[order]
        at = np.arange(0, len(order), settings.leaf)
        parts = [self._level(at, len(order), self.least_label, self.labels, self.rows, self.tops)]
        base, self.pages = 0, len(at)
        while len(parts[-1][0]) > 1:
            _, _, least, most, low, high = parts[-1]
            at = np.arange(0, len(least), settings.fan)
            level = self._level(at, len(least), least, most, low, high)
            parts.append((level[0] + base, level[1] + base, *level[2:]))
            base += len(least)
        self.first, self.last, self.least, self.most, self.low, self.high = (np.concatenate(x) for x in zip(*parts, strict=True))

    @classmethod
    def of(cls, table: pa.Table, settings: Settings) -> Tree:
        dim = table.column("dim")[0].as_py()
        low, high = (_vectors(table.column(c).combine_chunks(), dim) for c in ("vec", "high"))
        ids, labels, least = (table.column(c).to_numpy() for c in ("id", "label", "low_label"))
        return cls(ids, labels, low, high, least, settings)

    @staticmethod
    def _level(at, n, least, most, low, high):
        return (
            at, np.append(at[1:], n), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
            np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
        )

    @property
    def root(self) -> int:
        return len(self.first) - 1

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with anything in each node's box."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T


class Best:
    """The first ``k`` of the scores up to ``most``, ties by smaller id."""

    def __init__(self, k: int, least: float, most: float) -> None:
        self.k, self.least, self.most = k, least, most
        self.kept: list[tuple[float, int]] = []

    def floor(self) -> float:
        """No score below this one is wanted any more."""
        return max(self.least, -self.kept[-1][0]) if len(self.kept) == self.k else self.least

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero((scores <= self.most) & (scores >= self.floor()))
        if len(good) > self.k:
            good = good[np.lexsort((ids[good], -scores[good]))[: self.k]]
        if len(good):
            self.kept = sorted([*self.kept, *zip((-scores[good]).tolist(), ids[good].tolist(), strict=True)])[: self.k]


def walk(tree: Tree, query: np.ndarray, low: np.ndarray, high: np.ndarray, skip: Callable, usable: Callable, bests: list[Best]) -> int:
    """Open nodes by falling bound until no window can gain; returns the number of pages whose rows were scored.

    ``low`` and ``high`` are the query's bounds of every node; ``skip`` tells by a node's labels that none of its
    rows is usable, ``usable`` which rows of a page are.
    """
    queue = [(-high[tree.root], tree.root)]
    opened = 0
    while queue:
        top, node = heapq.heappop(queue)
        if -top < min(b.floor() for b in bests):
            break  # all others are lower still
        if not any(-top >= b.floor() and low[node] <= b.most for b in bests):
            continue
        first, last = int(tree.first[node]), int(tree.last[node])
        if node >= tree.pages:
            for child in range(first, last):
                if not skip(tree.least[child], tree.most[child]):
                    heapq.heappush(queue, (-high[child], child))
            continue
        opened += 1
        rows = first + np.flatnonzero(usable(tree.ids[first:last], tree.labels[first:last]))
        if len(rows):
            scores = tree.rows[rows] @ query
            for b in bests:
                b.add(scores, tree.ids[rows])
    return opened


# --- streaming rows past an index ------------------------------------------------------------------------------


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def beside(index: DataFrame, rows: DataFrame, parts: int, build: Callable, work: Callable, schema: str) -> DataFrame:
    """Per ``part``: ``build`` something of the index rows of each length of vector, then stream ``rows`` past it.

    Both tables have the same columns, ``part`` and ``dim`` among them. ``build(table)`` gets the index rows of one
    part and length, ``work(built, batch)`` yields batches of ``schema``. A task holds the index rows of one part and
    one batch of rows; rows whose part has no index rows of their length give nothing.
    """
    names = index.columns
    both = index.withColumn("side", F.lit(0)).unionByName(rows.select(*names).withColumn("side", F.lit(1)))
    dealt = both.repartition(parts, "part").sortWithinPartitions("part", "side", "dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, built = None, [], {}
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("part", "side", "dim")])
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1, [batch.num_rows]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b <= a:
                    continue
                rows = batch.slice(a, b - a)
                now, side, dim = (int(x) for x in keys[:, a])
                if now != part:
                    part, held, built = now, [], {}
                if side == 0:
                    held.append((dim, rows))
                    continue
                if held:
                    for d in {d for d, _ in held}:
                        built[d] = build(pa.Table.from_batches([r for e, r in held if e == d]).combine_chunks())
                    held = []
                if dim in built:
                    yield from work(built[dim], rows)

    return dealt.mapInArrow(run, schema)


def shards(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` ranged into shards of about ``shard_rows``, staged, with the shard's number as ``part``.

    The order is length, label, slabs of the widest coordinates, id, so rows of one label or equal vectors spread
    over as many shards as they need.
    """
    rows = stage(rows, "vectors")
    total = rows.count()
    share = min(1.0, 2.0 * settings.sample_rows / max(1, total))
    sample = rows.select("dim", "vec").sample(share, seed=1).limit(settings.sample_rows).toArrow()
    keys = [F.col("dim"), F.col("label")]
    if sample.num_rows:
        dims = sample.column("dim").combine_chunks()
        usual = pa.compute.mode(dims)[0]["mode"].as_py()
        seen = _vectors(sample.filter(pa.compute.equal(sample.column("dim"), usual)).column("vec").combine_chunks(), usual)
        for at in np.argsort(-seen.var(axis=0), kind="stable")[: settings.coordinates]:
            edges = np.unique(np.quantile(seen[:, at], np.arange(1, settings.slabs) / settings.slabs))
            value = F.coalesce(F.try_element_at("vec", F.lit(int(at) + 1)), F.lit(0.0))
            keys.append(sum((F.when(value >= float(e), 1).otherwise(0) for e in edges), F.lit(0)))
    # a small table is shared by all tasks as well
    spread = min(ceil(total / settings.least_rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = max(1, ceil(total / settings.shard_rows), spread)
    ranged = rows.repartitionByRange(n, *keys, F.col("vec_id"), F.xxhash64("vec"))
    return stage(ranged.withColumn("part", F.spark_partition_id().cast("long")), "shards")


def directory(sharded: DataFrame) -> DataFrame:
    """Per shard and length of vector the box of its rows and their least and greatest label."""

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _boxes(pa.Table.from_batches([batch]), "vec", "vec", "label", "label").to_batches()

    def merge(group: pa.Table) -> pa.Table:
        return _boxes(group, "vec", "high", "low_label", "label")

    schema = "part long, dim int, low_label long, label long, vec array<double>, high array<double>"
    found = sharded.select("part", "dim", "label", "vec").mapInArrow(boxes, schema)
    return found.groupBy("part", "dim").applyInArrow(merge, schema)


def _boxes(table: pa.Table, low: str, high: str, least: str, most: str) -> pa.Table:
    part, dims = (table.column(c).to_numpy() for c in ("part", "dim"))
    out = []
    for p, d in sorted(set(zip(part.tolist(), dims.tolist(), strict=True))):
        rows = table.filter(pa.array((part == p) & (dims == d)))
        box = [f(_vectors(rows.column(c).combine_chunks(), d), axis=0) for f, c in ((np.min, low), (np.max, high))]
        out.append((p, d, rows.column(least).to_numpy().min(), rows.column(most).to_numpy().max(), *map(np.ndarray.tolist, box)))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    columns = zip(*out, strict=True) if out else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "dim", "low_label", "label", "vec", "high"])


def routed(boxes: DataFrame, anchors: DataFrame, wanted: Callable, settings: Settings) -> DataFrame:
    """``part`` of every shard that an anchor must see, with the anchor's columns.

    Pages of the directory are copied for every ``salt_anchors`` anchors, so that a page, which all of them meet, is
    no single task.
    ``wanted(tree, query, label, bounds, low, high)`` tells which boxes matter.
    """
    salts = max(1, ceil(anchors.count() / settings.salt_anchors))
    pages = max(1, ceil(boxes.count() / settings.page_shards))
    page = F.pmod(F.xxhash64("part", "dim"), F.lit(pages))
    index = boxes.select(
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), page.alias("page"), F.col("part").alias("id"), "low_label", "label", "dim", "vec", "high"
    ).withColumns({"bounds": F.lit(None).cast("array<long>"), "anchor": F.lit(None).cast("long")})
    index = index.withColumn("part", F.col("page") * salts + F.col("salt")).drop("page", "salt")
    salt = F.pmod(F.xxhash64("anchor"), F.lit(salts))
    rows = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page")).select(
        (F.col("page") * salts + salt).alias("part"), F.col("vec_id").alias("id"), "label", "dim", F.col("label").alias("low_label"),
        "vec", F.lit(None).cast("array<double>").alias("high"), "bounds", "anchor",
    )

    def work(tree: Tree, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = _vectors(batch.column("vec"), batch.column("dim")[0].as_py())
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        low, high = plus @ tree.rows.T + minus @ tree.tops.T, plus @ tree.tops.T + minus @ tree.rows.T
        for i in range(batch.num_rows):
            bounds = batch.column("bounds")[i].as_py()
            at = np.flatnonzero(wanted(tree.least_label, tree.labels, batch.column("label")[i].as_py(), bounds, low[i], high[i]))
            if len(at):
                yield pa.record_batch([pa.array(np.repeat(batch.column("anchor")[i].as_py(), len(at))), pa.array(tree.ids[at])], names=["anchor", "part"])

    found = beside(index, rows, pages * salts, partial(Tree.of, settings=settings), work, "anchor long, part long").distinct()
    return found.join(anchors, "anchor")


def searched(sharded: DataFrame, visits: DataFrame, same: bool, settings: Settings) -> DataFrame:
    """The best ``k`` rows of each shard for each anchor sent there and each of its windows (``slot``)."""
    index = sharded.select(
        "part", F.col("vec_id").alias("id"), "label", "dim", F.col("label").alias("low_label"), "vec",
        F.col("vec").alias("high"), F.lit(None).cast("array<long>").alias("bounds"), F.lit(None).cast("long").alias("anchor"),
    )
    rows = visits.select(
        "part", F.col("vec_id").alias("id"), "label", "dim", F.col("label").alias("low_label"), "vec",
        F.lit(None).cast("array<double>").alias("high"), "bounds", "anchor",
    )
    k, percent = settings.k, settings.percent

    def work(tree: Tree, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = _vectors(batch.column("vec"), batch.column("dim")[0].as_py())
        lows, highs = tree.bounds(queries)
        out = []
        for i in range(batch.num_rows):
            own, label, anchor = (batch.column(c)[i].as_py() for c in ("id", "label", "anchor"))
            tops = batch.column("bounds")[i].as_py()
            bests = [Best(k, -(-percent * t // 100), t) for t in tops] if tops else [Best(k, -np.inf, np.inf)]
            if same:
                walk(tree, queries[i], lows[i], highs[i], lambda a, b: a > label or b < label, lambda ids, ls: (ls == label) & (ids != own), bests)  # noqa: B023
            else:
                walk(tree, queries[i], lows[i], highs[i], lambda a, b: a == b == label, lambda ids, ls: ls != label, bests)  # noqa: B023
            out += [(anchor, slot, vec_id, int(-score)) for slot, b in enumerate(bests) for score, vec_id in b.kept]
        if out:
            columns = zip(*out, strict=True)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "slot", "vec_id", "score"])

    parts = max(1, int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = beside(index, rows, parts, partial(Tree.of, settings=settings), work, _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: str, settings: Settings = Settings()) -> DataFrame:
    """For each anchor and positive the first ``k`` negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, scores.

    ``rows`` are those of ``whole_vectors``; the condition ``is_anchor`` chooses the anchors. Positives are the
    first ``k`` rows of the anchor's label with another id, negatives the first ``k`` of other labels that score
    from ``percent`` of the positive up to the positive; higher scores first, ties by smaller ``vec_id``. Scores
    are exact while sums of products stay below 2**53. Rows that share an id but not label and vector are rows
    each; vectors are compared with those of their length. An anchor without positives, or a positive
    without negatives, has no row; an empty table gives none.
    """
    sharded = shards(rows, settings)
    boxes = stage(directory(sharded), "directory")
    anchors = sharded.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id())
    anchors = stage(anchors.select("anchor", "vec_id", "label", "dim", "vec"), "anchors")

    first = anchors.withColumn("bounds", F.lit(None).cast("array<long>"))
    visits = routed(boxes, first, lambda least, most, label, bounds, low, high: (least <= label) & (most >= label), settings)
    positives = searched(sharded, visits, True, settings)
    positives = stage(positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "positives")

    percent = settings.percent

    def in_window(least, most, label, bounds, low, high):
        inside = np.zeros(len(low), dtype=bool)
        for top in bounds:
            inside |= (low <= top) & (100 * high >= percent * top)
        return inside & ~((least == label) & (most == label))

    # a window from 80 % of a score below zero up to that score is empty
    ranked = positives.where("positive_score >= 0").groupBy("anchor")
    windows = ranked.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "positive_score"))), lambda s: s["positive_score"]).alias("bounds"))
    second = stage(anchors.join(windows, "anchor"), "windows")
    negatives = searched(sharded, routed(boxes, second, in_window, settings), False, settings)
    negatives = negatives.select("anchor", (F.col("slot") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # positives of a score below zero come after all others, so places are the ranks
    pairs = positives.select("anchor", F.col("rank").alias("place"), "positive_id", "positive_score").join(negatives, ["anchor", "place"])
    return pairs.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def swapped_labels(rows: DataFrame) -> DataFrame:
    """``rows`` with the next label of ten where the id is divisible by seven."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.withColumn("label", moved)
