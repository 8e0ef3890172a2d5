"""Exact top-k search by inner product: a dual-tree search over cover trees.

Pivots chosen from a bounded sample, a cover of it, are the first level: every candidate belongs to the cell of its
nearest pivot, and shards of bounded size follow the cells. A cell of a shard is a ball around its pivot. A query
first visits the shard of its best cell, and then only shards with a ball in which a score can reach the worst of
the k found there. Each shard is one cover tree; queries stream past it in batches, each batch a cover tree too, and
both are walked at once: a pair of nodes is left out if no query under the one can score higher with any
candidate under the other than the worst k-th score found so far for those queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.hard_negatives import beside
from demandspark.sources.staging import stage

SCHEMA = "query long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the rows that pivots are chosen from; what is found does not depend on them. Shards hold
    ``shard_rows``, or fewer in a table that has too few for all tasks, down to ``least_rows``."""

    k: int = 5
    shard_rows: int = 16384
    least_rows: int = 2048
    leaf: int = 64
    sample_rows: int = 4096
    pivots: int = 256
    page_shards: int = 4096
    salt_queries: int = 1024


@dataclass
class Node:
    low: int
    high: int
    center: np.ndarray
    norm: float
    radius: float
    children: list[Node]


def cover_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, Node]:
    """An order of the points and a tree over it; a node holds the points ``low`` to ``high`` of that order.

    On a level with scale ``s`` the children's centers are more than ``s / 2`` apart and every point lies
    within ``s / 2`` of its child's center; the first child keeps its parent's center. A set that such
    balls do not gather stays a leaf, as do small sets and sets of equal points.
    """
    order = np.arange(len(points))

    def distances(rows: np.ndarray, center: int) -> np.ndarray:
        return np.sqrt(((points[rows] - points[center]) ** 2).sum(axis=1))

    def node(low: int, high: int, center: int, dist: np.ndarray) -> Node:
        return Node(low, high, points[center], float(np.linalg.norm(points[center])), float(dist.max(initial=0.0)), [])

    root = node(0, len(points), 0, distances(order, 0)) if len(points) else Node(0, 0, np.zeros(points.shape[1]), 0.0, 0.0, [])
    todo = [(root, 0, distances(order, 0) if len(points) else np.zeros(0))]
    while todo:
        at, center, dist = todo.pop()
        n = at.high - at.low
        if n <= leaf or at.radius == 0:
            continue
        rows = order[at.low : at.high]
        reach = 2.0 ** np.ceil(np.log2(at.radius)) / 2
        groups, left, left_dist = [], rows, dist
        pick = center
        while len(left):
            near = left_dist <= reach
            groups.append((pick, left[near], left_dist[near]))
            left = left[~near]
            if len(groups) > 32 and len(groups) * 8 > n - len(left):
                break  # the balls hold few points each
            if len(left):
                pick = int(left[0])
                left_dist = distances(left, pick)
        if len(left) or len(groups) == 1:
            continue
        low = at.low
        for pick, members, d in groups:
            order[low : low + len(members)] = members
            child = node(low, low + len(members), pick, d)
            at.children.append(child)
            todo.append((child, pick, d))
            low += len(members)
    return order, root


class Search:
    """The k best candidates of every query of a batch among the candidates of a shard.

    ``floor`` holds a score for each query that is known to be reached k times elsewhere: lower ones are not wanted.
    """

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, shard: Shard, floor: np.ndarray, settings: Settings) -> None:
        self.q_order, self.q_root = cover_tree(q, settings.leaf)
        self.q_ids, self.q, self.floor = q_ids[self.q_order], q[self.q_order], floor[self.q_order]
        self.c_ids, self.c, self.c_root = shard.ids, shard.rows, shard.root
        self.k = settings.k
        self.score = np.full((len(q), self.k), -np.inf)
        self.best = np.full((len(q), self.k), np.iinfo(np.int64).max)
        # rounding of the bound, far above that of its float operations
        self.slack = 1e-9 * (1.0 + np.abs(q).max(initial=0.0) * np.abs(self.c).max(initial=0.0) * q.shape[1])

    def worst(self, rows: slice | np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def bound(self, a: Node, b: Node) -> float:
        """No query under ``a`` scores higher with a candidate under ``b``."""
        return float(a.center @ b.center) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius + self.slack

    def run(self) -> None:
        if not len(self.q) or not len(self.c):
            return
        todo = [(self.bound(self.q_root, self.c_root), self.q_root, self.c_root)]
        while todo:
            most, a, b = todo.pop()
            if most < self.worst(slice(a.low, a.high)).min():  # an equal score may still win by its smaller id
                continue
            if a.children and (a.radius >= b.radius or not b.children):
                pairs = [(self.bound(x, b), x, b) for x in a.children]
            elif b.children:
                pairs = [(self.bound(a, x), a, x) for x in b.children]
            else:
                self.compare(a, b)
                continue
            todo += sorted(pairs, key=lambda p: p[0])  # the most promising pair is taken first

    def compare(self, a: Node, b: Node) -> None:
        q, c = slice(a.low, a.high), slice(b.low, b.high)
        new = self.q[q] @ self.c[c].T
        ids = self.c_ids[c]
        new[self.q_ids[q][:, None] == ids[None, :]] = -np.inf
        rows = np.flatnonzero((new >= self.worst(q)[:, None]).any(axis=1))
        if not len(rows):
            return
        at = rows + a.low
        score = np.hstack([self.score[at], new[rows]])
        best = np.hstack([self.best[at], np.broadcast_to(ids, (len(rows), len(ids)))])
        order = np.lexsort((best, -score), axis=1)[:, : self.k]
        self.score[at] = np.take_along_axis(score, order, axis=1)
        self.best[at] = np.take_along_axis(best, order, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, column = np.nonzero(np.isfinite(self.score) & (self.score >= self.floor[:, None]))
        return self.q_order[row], self.best[row, column], self.score[row, column].astype(np.int64)


def whole_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``vec``: each component times ``scale``, rounded down.

    Rows with a null id, a null or empty vector, or a component that is null or not finite are left out.
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    vec = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    rows = df.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), F.size(vec).alias("dim"))


@dataclass
class Shard:
    ids: np.ndarray
    rows: np.ndarray
    root: Node

    @classmethod
    def of(cls, table: pa.Table, settings: Settings) -> Shard:
        points = _vectors(table.column("vec").combine_chunks(), table.column("dim")[0].as_py())
        order, root = cover_tree(points, settings.leaf)
        return cls(table.column("id").to_numpy()[order], points[order], root)


def cover_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` rows of a sample, each as far from those before as can be: whatever the number, the sample lies
    within the smallest distance between two of them."""
    if not len(sample):
        return sample
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < most and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def pivots_of(candidates: DataFrame, total: int, settings: Settings) -> np.ndarray:
    """Pivots for the most usual length of vector, from a bounded sample."""
    share = min(1.0, 2.0 * settings.sample_rows / max(1, total))
    sample = candidates.select("dim", "vec").sample(share, seed=1).limit(settings.sample_rows).toArrow()
    if not sample.num_rows:
        return np.zeros((0, 1))
    usual = pa.compute.mode(sample.column("dim").combine_chunks())[0]["mode"].as_py()
    seen = sample.filter(pa.compute.equal(sample.column("dim"), usual)).column("vec").combine_chunks()
    return cover_pivots(_vectors(seen, usual), settings.pivots)


def in_cells(candidates: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Candidates with the ``cell`` of their nearest pivot and its distance; 0 and infinite for other lengths."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, far = np.zeros(len(dims), dtype=np.int32), np.full(len(dims), np.inf)
            same = np.flatnonzero(dims == pivots.shape[1])
            if len(pivots):
                for at in np.array_split(same, max(1, len(same) // 2048)):
                    d = _distances(_vectors(batch.column("vec").take(pa.array(at)), pivots.shape[1]), pivots)
                    cell[at] = d.argmin(axis=1)
                    far[at] = d.min(axis=1)
            yield pa.record_batch([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return candidates.select("vec_id", "vec", "dim").mapInArrow(work, "vec_id long, vec array<double>, dim int, cell int, far double")


def routed(balls: DataFrame, queries: DataFrame, pivots: np.ndarray, first: bool, settings: Settings) -> DataFrame:
    """``part`` of every shard that a query must visit: the one of its best ball, or all others that can matter.

    ``queries`` have a ``floor``, and for the second visit the ``home`` of the first. Pages of the balls are copied
    for every ``salt_queries`` queries.
    """
    salts = max(1, ceil(queries.count() / settings.salt_queries))
    pages = 1 if first else max(1, ceil(balls.count() / settings.page_shards))
    if first:  # one ball per cell is enough to choose a home
        balls = balls.groupBy("dim", "cell").agg(F.min("part").alias("part"), F.max("radius").alias("radius"))
    page = F.pmod(F.xxhash64("part"), F.lit(pages))
    copies = balls.select("*", page.alias("page"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    index = copies.select(
        (F.col("page") * salts + F.col("salt")).alias("part"), "dim", F.col("part").cast("long").alias("id"),
        F.col("cell").cast("long").alias("cell"), "radius", F.lit(None).cast("array<double>").alias("vec"), F.lit(None).cast("long").alias("query"),
    )
    salt = F.pmod(F.xxhash64("query"), F.lit(salts))
    rows = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page")).select(
        (F.col("page") * salts + salt).alias("part"), "dim", F.col("home").alias("id"), F.lit(None).cast("long").alias("cell"),
        F.col("floor").alias("radius"), "vec", "query",
    )

    def build(table: pa.Table) -> tuple[np.ndarray, ...]:
        return tuple(table.column(c).to_numpy() for c in ("id", "cell", "radius"))

    def work(ball: tuple[np.ndarray, ...], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part, cell, radius = ball
        dim = batch.column("dim")[0].as_py()
        q = _vectors(batch.column("vec"), dim)
        if dim == pivots.shape[1]:
            with np.errstate(invalid="ignore"):
                bound = (q @ pivots.T)[:, cell] + np.linalg.norm(q, axis=1)[:, None] * radius[None, :]
            bound += 1e-9 * (1.0 + np.abs(bound))
        else:  # lengths without pivots: every shard may hold something
            bound = np.full((len(q), len(part)), np.inf)
        if first:
            at = np.arange(len(q)), bound.argmax(axis=1)
        else:
            floor, home = batch.column("radius").to_numpy(), batch.column("id").to_numpy()
            at = np.nonzero((bound >= floor[:, None]) & (part[None, :] != home[:, None]))
        pairs = np.unique(np.stack([batch.column("query").to_numpy()[at[0]], part[at[1]]]), axis=1)
        yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["query", "part"])

    found = beside(index, rows, pages * salts, build, work, "query long, part long").distinct()
    return found.join(queries, "query")


def visited(sharded: DataFrame, visits: DataFrame, settings: Settings) -> DataFrame:
    """The k best of each shard for each query sent there: ``query``, ``query_id``, ``vec_id``, ``score``."""
    index = sharded.select(
        F.col("part").cast("long").alias("part"), "dim", F.col("vec_id").alias("id"), "vec", F.lit(None).cast("double").alias("floor"), F.lit(None).cast("long").alias("query")
    )
    rows = visits.select(F.col("part").cast("long").alias("part"), "dim", F.col("vec_id").alias("id"), "vec", "floor", "query")

    def work(shard: Shard, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q = _vectors(batch.column("vec"), batch.column("dim")[0].as_py())
        task = Search(batch.column("id").to_numpy(), q, shard, batch.column("floor").to_numpy(), settings)
        task.run()
        row, best, score = task.found()
        asked = batch.take(pa.array(row))
        columns = [asked.column("query"), asked.column("id"), pa.array(best), pa.array(score)]
        yield pa.record_batch(columns, names=["query", "query_id", "vec_id", "score"])

    parts = max(1, int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return beside(index, rows, parts, partial(Shard.of, settings=settings), work, SCHEMA)


def dealt(queries: DataFrame, candidates: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """Queries with a number, candidates in shards, the balls of the shards, and the pivots."""
    queries = stage(queries.select("vec_id", "vec", "dim").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    total = candidates.count()
    pivots = pivots_of(candidates, total, settings)
    spread = min(ceil(total / settings.least_rows), int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = max(1, ceil(total / settings.shard_rows), spread)
    ranged = in_cells(candidates, pivots).repartitionByRange(n, "dim", "cell", "vec_id", F.xxhash64("vec"))
    sharded = stage(ranged.withColumn("part", F.spark_partition_id()), "shards")
    balls = stage(sharded.groupBy("part", "dim", "cell").agg(F.max("far").alias("radius")), "balls")
    return queries, sharded, balls, pivots


def search(queries: DataFrame, candidates: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The k best candidates of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Both sides hold whole-numbered vectors as ``whole_vectors`` makes them. A query row that is repeated is asked
    once; rows that share an id but not the vector are queries each, whose ranks come one after the other. Scores are
    exact while sums of products stay below 2**53. Ties go to the smaller ``vec_id``; a candidate with the query's
    own id is not compared; rows that repeat a candidate are candidates each. Vectors are compared with those of
    their own length. No queries or no candidates give no rows. Candidates are shuffled once, however many queries
    there are; pass a stored table.
    """
    queries, sharded, balls, pivots = dealt(queries, candidates, settings)
    start = queries.withColumns({"floor": F.lit(float("-inf")), "home": F.lit(-1).cast("long")})
    homes = stage(routed(balls, start, pivots, True, settings), "homes")
    first = stage(visited(sharded, homes, settings), "first")
    kth = first.groupBy("query").agg(
        F.when(F.count(F.lit(1)) >= settings.k, F.min("score").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor")
    )
    again = homes.select("query", "vec_id", "vec", "dim", F.col("part").alias("home")).join(kth, "query", "left")
    again = stage(again.withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "again")
    found = first.unionByName(visited(sharded, routed(balls, again, pivots, False, settings), settings))
    order = Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def staged_vectors(df: DataFrame) -> DataFrame:
    return stage(whole_vectors(df), "vectors")
