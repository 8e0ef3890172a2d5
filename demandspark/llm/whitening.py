"""Embedding whitening from the covariance of distinct vectors, each weighted by how often it occurs.

Vectors become whole numbers, equal ones are grouped, and sums, covariance and projection are worked out once
per distinct vector. A task multiplies its centred vectors into one matrix of the vectors' length; the matrices
are added up in Spark and the driver sees the sum only. Whitened vectors are joined back to their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.sources.staging import stage

_LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Settings:
    """``by_count``: a vector counts as often as it occurs, else once. ``hot_keys``: a vector with more than one
    part in ``hot_keys`` of all rows is joined by broadcast; there are fewer than ``hot_keys`` of them."""

    components: int = 32
    scale: int = 64
    offset: int = 1_000_000
    by_count: bool = True
    hot_keys: int = 4096
    block_values: int = 1 << 19


@dataclass(frozen=True)
class Fit:
    """What the driver knows of the vectors of one length."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a row per component
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less its mean. The whole part of the mean is taken off in whole numbers, which loses nothing."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.float64) / self.n
        return (x - whole).astype(np.float64) - rest


def whole_vectors(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id``, ``x`` (whole numbers) and ``key``, which is the same for equal ``x`` only.

    Rows with a null or empty vector, a component that is null or not finite, or one whose whole number does not
    fit a long are left out. A null ``vec_id`` stays, and so do rows that repeat one.
    """
    c = F.col("embedding").cast("array<double>")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c"))
    room = float(1 << 62)
    fine = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * F.lit(float(settings.scale))) < F.lit(room)))
    rows = rows.where(F.coalesce(fine, F.lit(False)) & (F.size("c") > 0))
    x = F.transform("c", lambda v: F.floor(v * F.lit(float(settings.scale))) + F.lit(settings.offset).cast("long"))
    rows = rows.select("vec_id", x.alias("x"))
    return rows.withColumn("key", F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"), 256)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _blocks(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each length in blocks of some ``block_values`` components."""
    for batch in batches:
        for dim in pa.compute.unique(batch.column("dim")).to_pylist():
            rows = batch.filter(pa.compute.equal(batch.column("dim"), dim))
            step = max(1, settings.block_values // dim)
            for at in range(0, rows.num_rows, step):
                yield dim, rows.slice(at, step)


def sums(distinct: DataFrame, settings: Settings) -> dict[int, tuple[int, list[int]]]:
    """Per length: the number of vectors and the exact sum of each component."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for dim, rows in _blocks(batches, settings):
            x, w = _matrix(rows.column("x"), dim), rows.column("weight").to_numpy()
            if int(np.abs(x.astype(np.float64)).max()) * int(w.sum()) >= 1 << 61:
                x, w = x.astype(object), w.astype(object)
            part = [int(w.sum()), *map(int, w @ x)]
            total[dim] = [a + b for a, b in zip(total[dim], part, strict=True)] if dim in total else part
        for dim, values in total.items():
            yield pa.record_batch(
                [pa.array([dim] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array(map(str, values))],
                names=["dim", "place", "total"],
            )

    parts = distinct.select("dim", "x", "weight").mapInArrow(work, "dim int, place int, total string")
    parts = parts.groupBy("dim", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[int, dict[int, int]] = {}
    for row in parts.toLocalIterator():  # one number per component
        found.setdefault(row.dim, {})[row.place] = int(row.total)
    return {dim: (by[0], [by[i] for i in range(1, dim + 1)]) for dim, by in found.items()}


def scatter(
    distinct: DataFrame, columns: list[str], centred: Callable[[int, pa.RecordBatch], np.ndarray], settings: Settings
) -> dict[int, np.ndarray]:
    """Per length: the sum over vectors of weight times the outer product of the centred vector with itself."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, rows in _blocks(batches, settings):
            z = centred(dim, rows)
            part = (z * rows.column("weight").to_numpy()[:, None]).T @ z
            total[dim] = total[dim] + part if dim in total else part
        for dim, m in total.items():
            line = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1)))
            yield pa.record_batch(
                [pa.array([dim] * len(m), pa.int32()), pa.array(np.arange(len(m), dtype=np.int32)), line], names=["dim", "place", "line"]
            )

    def add(group: pa.Table) -> pa.Table:
        lines = group.column("line").combine_chunks()
        line = lines.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"dim": group.column("dim")[:1], "place": group.column("place")[:1], "line": pa.array([line])})

    schema = "dim int, place int, line array<double>"
    parts = distinct.select("dim", "weight", *columns).mapInArrow(multiply, schema)
    found: dict[int, dict[int, np.ndarray]] = {}
    for row in parts.groupBy("dim", "place").applyInArrow(add, schema).toLocalIterator():  # one matrix per length
        found.setdefault(row.dim, {})[row.place] = np.array(row.line)
    return {dim: np.stack([by[i] for i in range(len(by))]) for dim, by in found.items()}


def fit(distinct: DataFrame, settings: Settings) -> dict[int, Fit]:
    """Per length: eigenvectors of the covariance by falling eigenvalue.

    Left out are components whose eigenvalue is no more than rounding, since a direction without variance cannot
    be scaled to variance one. The sign makes the greatest entry of an eigenvector positive.
    """
    known = {dim: Fit(n, s, np.zeros((0, dim)), np.zeros(0), 0.0) for dim, (n, s) in sums(distinct, settings).items()}
    found = scatter(distinct, ["x"], lambda dim, rows: known[dim].centred(_matrix(rows.column("x"), dim)), settings)
    fits = {}
    for dim, m in found.items():
        v = (m + m.T) / 2 / known[dim].n
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1], vectors.T[::-1]
        keep = np.flatnonzero(values > dim * np.finfo(float).eps * max(values[0], 0.0))[: settings.components]
        vectors = vectors[keep]
        sign = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1))
        fits[dim] = Fit(known[dim].n, known[dim].sums, vectors * sign, values[keep], float(np.trace(v)))
    return fits


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over components of ``(n * x - total) ** 2``, exact; null where that does not fit a long."""
    most = max(float(np.abs(x.astype(np.float64)).max(initial=0)) * n, max(abs(t) for t in total))
    if most < 1 << 61:
        off = x * n - np.array(total, dtype=np.int64)
        if float(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
            return (off * off).sum(axis=1).tolist()
    off = x.astype(object) * n - np.array(total, dtype=object)
    exact = map(int, (off * off).sum(axis=1))
    return [v if v <= _LONG.max else None for v in exact]


def project(distinct: DataFrame, fits: dict[int, Fit], settings: Settings) -> DataFrame:
    """Each distinct vector whitened: ``key``, ``dim``, ``weight``, ``rows``, ``deviation``, ``whitened``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows in _blocks(batches, settings):
            f, x = fits[dim], _matrix(rows.column("x"), dim)
            w = f.centred(x) @ (f.vectors / np.sqrt(f.values)[:, None]).T
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.reshape(-1)))
            off = pa.array(deviations(x, f.n, f.sums), pa.int64())
            kept = [rows.column(c) for c in ("key", "dim", "weight", "rows")]
            yield pa.record_batch([*kept, off, lists], names=["key", "dim", "weight", "rows", "deviation", "whitened"])

    return distinct.mapInArrow(work, "key binary, dim int, weight long, rows long, deviation long, whitened array<double>")


def identity_errors(whitened: DataFrame, fits: dict[int, Fit], settings: Settings) -> dict[int, float]:
    """Per length: the largest absolute entry of the covariance of the whitened vectors less the identity."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, rows in _blocks(batches, settings):
            part = rows.column("weight").to_numpy() @ _matrix(rows.column("whitened"), len(fits[dim].values))
            total[dim] = total[dim] + part if dim in total else part
        for dim, part in total.items():
            yield pa.record_batch(
                [pa.array([dim] * len(part), pa.int32()), pa.array(np.arange(len(part), dtype=np.int32)), pa.array(part)],
                names=["dim", "place", "total"],
            )

    means = {dim: np.zeros(len(f.values)) for dim, f in fits.items()}
    parts = whitened.select("dim", "weight", "whitened").mapInArrow(count, "dim int, place int, total double")
    for row in parts.groupBy("dim", "place").agg(F.sum("total").alias("total")).toLocalIterator():
        means[row.dim][row.place] = row.total / fits[row.dim].n
    spread = scatter(
        whitened, ["whitened"], lambda dim, rows: _matrix(rows.column("whitened"), len(means[dim])) - means[dim], settings
    )
    return {dim: float(np.abs(m / fits[dim].n - np.eye(len(m))).max()) for dim, m in spread.items() if len(m)}


def whiten(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row's whitened components: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    The fit list is all rows that ``whole_vectors`` keeps; ``n`` is its length. Vectors of each length have a fit
    of their own, whose matrix the driver holds. Rows that repeat an id or a vector are rows each. ``deviation`` is
    null where it does not fit a long. Fewer components than asked for come back if no more have variance: equal
    vectors, or a single one, give no rows. Other columns are ignored; an empty table gives no rows.
    """
    rows = whole_vectors(df, settings)
    grouped = rows.groupBy("key").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("rows"))
    weight = F.col("rows") if settings.by_count else F.lit(1).cast("long")
    distinct = stage(grouped.select("key", F.size("x").alias("dim"), "x", "rows", weight.alias("weight")), "distinct")
    fits = fit(distinct, settings)
    whitened = stage(project(distinct, fits, settings), "whitened")
    errors = identity_errors(whitened, fits, settings)
    shares = [
        (dim, i + 1, f.n, float(e / f.trace), errors[dim]) for dim, f in fits.items() for i, e in enumerate(f.values) if dim in errors
    ]
    spark = df.sparkSession
    facts = spark.createDataFrame(shares, "dim int, component int, n long, explained double, identity_error double")
    facts = facts.groupBy("dim").agg(
        F.first("n").alias("n"),
        F.first("identity_error").alias("identity_error"),
        F.transform(F.array_sort(F.collect_list(F.struct("component", "explained"))), lambda s: s["explained"]).alias("explained"),
    )
    # at most `components` numbers for each length of vectors
    values = whitened.join(F.broadcast(facts), "dim").select("key", "rows", "n", "deviation", "whitened", "explained", "identity_error")
    total = whitened.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") * settings.hot_keys > total
    ids = rows.select("vec_id", "key")
    few = values.where(hot)
    often = ids.join(F.broadcast(few), "key")
    seldom = ids.join(F.broadcast(few.select("key")), "key", "left_anti").join(values.where(~hot), "key")
    both = often.unionByName(seldom)
    parts = F.arrays_zip(F.sequence(F.lit(1), F.size("whitened")).alias("component"), "whitened", "explained")
    return (
        both.where(F.size("whitened") > 0)
        .select("vec_id", "n", "deviation", "identity_error", F.inline(parts))
        .select("vec_id", F.col("component").cast("int").alias("component"), "n", "deviation", "whitened", "explained", "identity_error")
    )
