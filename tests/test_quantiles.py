from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators.quantiles import exact_median, exact_quantiles, grouped_quantiles

P = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
SCHEMA = "g string, h int, v double, w long"


def rows(kind, n=3000, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"g{i % 40}")
        v = {"real": rng.random() * 100, "ties": float(rng.randrange(4)), "skew": rng.paretovariate(0.3)}[kind]
        out.append((g, i % 2, None if i % 17 == 0 else v, rng.choice([1, 1, 1, 500])))
    return out


def plain(data, weighted):
    groups = {}
    for g, h, v, w in data:
        if v is not None:
            groups.setdefault((g, h), []).extend([v] * (w if weighted else 1))
    return {k: (len(v), np.quantile(v, P)) for k, v in groups.items()}


@pytest.mark.parametrize("kind", ["real", "ties", "skew"])
@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("accuracy", [20, 2000])
def test_quantiles_are_exact_however_rough_the_bounds(spark, kind, weight, accuracy):
    data = rows(kind)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    found = {(r.g, r.h): (r.total, r.q) for r in grouped_quantiles(df, ["g", "h"], "v", P, weight, accuracy).collect()}
    want = plain(data, weight is not None)
    assert set(found) == set(want)
    for key, (n, q) in want.items():
        assert found[key][0] == n and np.allclose(found[key][1], q, rtol=1e-12), key


def test_whole_table_columns_and_edges(spark):
    data = rows("real")
    df = spark.createDataFrame(data, SCHEMA)
    values = [r[2] for r in data if r[2] is not None]
    assert exact_median(df, "v").first().median == pytest.approx(np.median(values), rel=1e-12)
    found = {r.column_name: r.q for r in exact_quantiles(df, ["v", "w", "h"], [0.25, 0.5]).collect()}
    assert np.allclose(found["v"], np.quantile(values, [0.25, 0.5])) and found["h"] == [0.0, 0.5]
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_median(empty, "v").first().median is None
    assert grouped_quantiles(empty, ["g"], "v", P).count() == 0
    nulls = spark.createDataFrame([("a", 1, None, 1), ("b", 1, 7.0, 1)], SCHEMA)
    assert [(r.g, r.q) for r in grouped_quantiles(nulls, ["g"], "v", [0.5]).collect()] == [("b", [7.0])]


def test_only_a_bracket_is_put_in_order(spark):
    """No aggregate keeps a map of values, and the rows that are sorted are few."""
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v"), F.lit("a").alias("g"))
    found = grouped_quantiles(df, ["g"], "v", [0.5])
    plan = found._jdf.queryExecution().toString()
    assert " percentile(" not in plan and "collect_" not in plan and " median(" not in plan
    assert found.first().q == df.agg(F.array(F.median("v")).alias("q")).first().q


def test_bounds_are_taken_once(spark):
    """Sketches depend on the order in which their parts arrive; the counts of the cells and the rows in them must
    come from the same one."""
    df = spark.range(50_000, numPartitions=16).select((F.col("id") % 3).alias("g"), F.rand(7).alias("v"))
    plan = grouped_quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().toString()
    assert "percentile_approx" not in plan
