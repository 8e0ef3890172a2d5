"""Exact quantiles by bracketed selection: no sort of the table and no buffer of a group's values.

A sketch gives two bounds around each quantile asked for. The bounds cut the values of a group into a few cells;
the rows in each cell are counted exactly, so it is known in which cell each rank lies and how many rows come
before. Only the values in those cells are then put in order. What the sketch decides is how few these are: with
bounds of 1 in ``accuracy`` some 6 rows in ``accuracy`` per quantile; the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.sources.staging import stage

ACCURACY = 2_000


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    weight: str | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``keys``, ``q`` (array of the quantiles, interpolated as ``percentile`` does) and ``total`` (weighted rows).

    Rows without a value count for nothing; a group without any has no row. Null keys are a group. ``weight`` names
    a column that tells how many rows each row stands for. ``df`` is read three times; pass a stored table. Without
    keys the result is one row, or none if there is no value.
    """
    keys = list(keys)
    rows = df.select(
        *keys,
        F.col(value).cast("double").alias("v_"),
        (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("w_"),
    ).filter(F.col("v_").isNotNull())
    if not keys:
        rows = rows.withColumn("g_", F.lit(0))
    by = keys or ["g_"]

    reach = 3 / accuracy
    ends = sorted({e for p in probabilities for e in (max(0.0, p - reach), min(1.0, p + reach))})
    bounds = rows.groupBy(*by).agg(F.percentile_approx("v_", F.array(*map(F.lit, ends)), accuracy).alias("ends_"))
    # written once: a sketch depends on the order in which its parts arrive, and cells are counted and read in two passes
    bounds = stage(bounds, "bounds")
    inside = _match(rows, bounds, by).withColumn("cell_", _cell(len(ends))).drop("ends_")

    cells = inside.groupBy(*by, "cell_").agg(F.sum("w_").alias("n_"))
    in_order = W.partitionBy(*by).orderBy("cell_")
    before = F.coalesce(F.sum("n_").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    all_cells = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cells = cells.withColumns({"before_": before, "total_": F.sum("n_").over(all_cells)})
    ranks = [f(F.lit(p) * (F.col("total_") - 1)) for p in probabilities for f in (F.floor, F.ceil)]
    holds = [(F.col("before_") <= r) & (r < F.col("before_") + F.col("n_")) for r in ranks]
    wanted = cells.filter(reduce(lambda a, b: a | b, holds)).drop("n_")

    values = _match(inside, wanted, [*by, "cell_"]).groupBy(*by, "cell_", "v_").agg(
        F.sum("w_").alias("n_"), F.first("before_").alias("before_"), F.first("total_").alias("total_")
    )
    in_cell = W.partitionBy(*by, "cell_").orderBy("v_").rowsBetween(W.unboundedPreceding, -1)
    placed = values.withColumn("before_", F.col("before_") + F.coalesce(F.sum("n_").over(in_cell), F.lit(0)))
    picked = placed.groupBy(*by, "total_").agg(*[F.max(F.when(h, F.col("v_"))).alias(f"r{i}_") for i, h in enumerate(holds)])

    def between(i: int) -> Column:
        low, high = F.col(f"r{2 * i}_"), F.col(f"r{2 * i + 1}_")
        spot = F.lit(probabilities[i]) * (F.col("total_") - 1)
        share = spot - F.floor(spot)
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high)

    return picked.select(*keys, F.array(*[between(i) for i in range(len(probabilities))]).alias("q"), F.col("total_").alias("total"))


def _cell(n: int) -> Column:
    """Which cell a value lies in; every bound has one of its own, so a value that is a bound many times is counted,
    and no other value with it."""
    ends = [F.get("ends_", F.lit(i)) for i in range(n)]
    steps = [(F.col("v_") >= e).cast("int") + (F.col("v_") > e).cast("int") for e in ends]
    return reduce(lambda a, b: a + b, steps)


def _match(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    renamed = right.select(*[F.col(c).alias(f"{c}__") for c in by], *[c for c in right.columns if c not in by])
    joined = left.join(renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in by]))
    return joined.drop(*[f"{c}__" for c in by])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """``column_name`` and ``q``, the exact quantiles of each column over the whole table; a column without a value has
    no row.

    All columns go through the steps of ``grouped_quantiles`` together, in three passes without a shuffle of rows:
    bounds, counts per cell, and the values of the few cells that hold a rank. Runs when called; the driver sees some
    numbers per column and quantile. ``df`` is read three times; pass a stored table.
    """
    spark = df.sparkSession
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    reach = 3 / accuracy
    shares = sorted({e for p in probabilities for e in (max(0.0, p - reach), min(1.0, p + reach))})
    sketch = [F.percentile_approx(f"c{i}", F.array(*map(F.lit, shares)), accuracy).alias(f"c{i}") for i in range(len(columns))]
    ends = [sorted(set(found or [])) for found in wide.agg(*sketch).first()]
    counts = [
        [F.count(c), *[F.count_if(test) for e in ends[i] for test in (c < e, c <= e)]]
        for i in range(len(columns))
        for c in (F.col(f"c{i}"),)
    ]
    numbers = iter(wide.agg(*[n.alias(f"n{k}") for k, n in enumerate(n for line in counts for n in line)]).first())

    wanted, spots = [], []  # cells with a rank inside: column, low and high end, rows before; and where each rank lies
    for i in range(len(columns)):
        total = next(numbers)
        upto = [next(numbers) for _ in range(2 * len(ends[i]))]
        for p in probabilities if total else ():
            spot = p * (total - 1)
            for rank in (int(spot // 1), int(-(-spot // 1))):
                cell = next((k for k, n in enumerate(upto) if n > rank), len(upto))
                if cell % 2:  # a bound itself
                    spots.append((i, p, rank, spot, ends[i][cell // 2]))
                    continue
                low = ends[i][cell // 2 - 1] if cell else None
                high = ends[i][cell // 2] if cell < len(upto) else None
                wanted.append((i, low, high, upto[cell - 1] if cell else 0, rank))
                spots.append((i, p, rank, spot, None))
    picked = _picked(wide, wanted) if wanted else {}
    rows = []
    for i, name in enumerate(columns):
        values = []
        mine = [x for x in spots if x[0] == i]
        for (_, p, low_rank, spot, low), (_, _, high_rank, _, high) in zip(mine[::2], mine[1::2], strict=True):
            low = picked[i, low_rank] if low is None else low
            high = picked[i, high_rank] if high is None else high
            share = spot - low_rank
            values.append(low if share == 0 else (1 - share) * low + share * high)
        if values:
            rows.append((name, values))
    return spark.createDataFrame(rows, "column_name string, q array<double>")


def _picked(wide: DataFrame, wanted: list[tuple]) -> dict[tuple[int, int], float]:
    """The values at the wanted ranks, which lie in open cells between two bounds."""
    cells = sorted({w[:4] for w in wanted}, key=str)
    parts = []
    for k, (i, low, high, _) in enumerate(cells):
        c = F.col(f"c{i}")
        inside = (F.lit(True) if low is None else c > low) & (F.lit(True) if high is None else c < high)
        parts.append(F.when(inside & c.isNotNull(), F.struct(F.lit(k).alias("cell"), c.alias("v"))))
    values = wide.select(F.inline(F.array_compact(F.array(*parts)))).groupBy("cell", "v").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("cell").orderBy("v").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = values.withColumn("before", before)
    asked = [(i, rank, k, rank - cells[k][3]) for i, low, high, n, rank in wanted for k in (cells.index((i, low, high, n)),)]
    tests = [
        F.max(F.when((F.col("cell") == k) & (F.col("before") <= r) & (r < F.col("before") + F.col("n")), F.col("v"))).alias(f"v{j}")
        for j, (_, _, k, r) in enumerate(asked)
    ]
    found = placed.agg(*tests).first()
    return {(i, rank): found[j] for j, (i, rank, _, _) in enumerate(asked)}


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, ``median``; null if the column has no value."""
    found = grouped_quantiles(df, [], column, [0.5]).select(F.get("q", F.lit(0)).alias("median"))
    return found.agg(F.max("median").alias("median"))
