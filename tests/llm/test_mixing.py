from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from compare import connect, differences
from helpers import SF, edge_docs, empty_docs, words

from demandspark.llm import mixing, queries


def plain(rows, recipe=mixing.Recipe()):
    """(doc_id, size, source_size, target, taken) of every row, by hand."""
    by = defaultdict(list)
    for i, source, text in rows:
        by[source].append((hashlib.md5(f"{'' if i is None else i}:{recipe.seed}".encode()).hexdigest(), i, len(words(text))))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(x[2] for x in by[s]) for s in names}
    weight = {s: recipe.weights[n % len(recipe.weights)] for n, s in enumerate(names)}
    full: set = set()
    while True:
        left = [s for s in names if s not in full]
        rest = recipe.share * sum(size.values()) - sum(recipe.most * size[s] for s in full)
        level = rest / sum(weight[s] for s in left) if left else 0
        more = {s for s in left if level * weight[s] > recipe.most * size[s]}
        if not more:
            break
        full |= more
    out = []
    for s in names:
        target = recipe.most * size[s] if s in full else min(recipe.most * size[s], level * weight[s])
        budget, before = int(target), 0
        for _, i, n in sorted(by[s], key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
            epochs, part = divmod(budget, size[s]) if size[s] else (0, 0)
            out.append((i, n, size[s], target, epochs * n + max(0, min(n, part - before))))
            before += n
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sql_twin(spark):
    df = queries.op5_source_mix(spark, SF)
    assert differences(df, connect(SF), queries.ORACLE["op5_source_mix"]) == []


def test_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    assert result(mixing.mix(docs)) == plain(rows)
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    assert result(mixing.mix(docs)) == plain(rows)


def test_targets_add_up_and_stop(spark):
    rows = [(i, "small" if i < 3 else "large", "w " * 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {r.source_key: r for r in mixing.targets(mixing.sized(docs, mixing.Recipe())).collect()}
    assert found["0small"].target == 60.0 and found["0large"].target == 1440.0
    assert sum(r.taken for r in mixing.mix(docs).collect()) == 1500


@pytest.mark.parametrize("share", [0.25, 1.5])
def test_documents_of_the_mix(spark, share):
    recipe = mixing.Recipe(share=share)
    docs = edge_docs(spark)
    out = mixing.mixed(docs, recipe)
    assert out.columns == docs.columns
    times = defaultdict(int)
    for r in out.collect():
        times[r.doc_id] += 1
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want, copies = defaultdict(int), defaultdict(int)
    for i, n, _, _, taken in plain(rows, recipe):
        copies[i] += 1
        want[i] += -(-taken // n) if n else 0  # a document on the cut stays whole
    for i in want:
        # rows that repeat a document share one key: the cut takes all of them or none
        assert times[i] == want[i] or copies[i] > 1 and want[i] <= times[i] <= copies[i] * -(-want[i] // copies[i])


def test_native_plan_and_empty_table(spark):
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.mixed(empty_docs(spark)).count() == 0
    plan = mixing.mix(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_runs_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(mixing.mix(docs)) == result(mixing.mix(docs.repartition(5)))


def test_reruns_agree_on_repeated_ids_with_other_sizes(spark):
    rows = [(i % 7, " ".join(["w"] * (1 + i % 5)), "a" if i % 3 else "b") for i in range(200)]
    rows += [(None, " ".join(["n"] * (i % 4)), "a") for i in range(40)]
    schema = "doc_id long, text string, source string"
    found = [
        sorted(map(tuple, mixing.mix(spark.createDataFrame(rows, schema).repartition(n)).collect()), key=repr) for n in (1, 3, 7)
    ]
    assert found[0] == found[1] == found[2] and len({r[4] for r in found[0] if r[0] is None}) > 1
