from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, documents, edge_docs, empty_docs, words

from demandspark.llm import minhash, queries
from demandspark.llm import text as T
from demandspark.llm.components import components


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def plain(rows):
    """Classes from all pairs of documents."""
    bags = [(i, bag(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}
    for (i, a), (j, b) in combinations(bags, 2):
        if i is None or j is None or not a or not b:
            continue
        shared = sum((a & b).values())
        if 100 * shared >= 80 * (sum(a.values()) + sum(b.values()) - shared):
            x, y = find(parent, i), find(parent, j)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, None if i is None else find(parent, i)) for i, _ in rows), key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "class_id").collect()), key=repr)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    want = plain(rows)
    assert result(queries.op10_near_dedup(spark, SF)) == want
    assert any(i != c for i, c in want)


def test_groups_of_copies_and_chains(spark):
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(3000)]
    rows, i = [], 0

    def edited(base, n):
        w = list(base)
        for at in rng.sample(range(len(w)), n):
            w[at] = rng.choice(pool)
        return w

    for size in (2, 3, 5, 40):
        base = rng.choices(pool, k=120)
        for _ in range(size):
            rows.append((i, " ".join(edited(base, rng.randint(0, 4)))))
            i += 1
    link = rng.choices(pool, k=200)
    for _ in range(12):  # each text is close to its neighbours only
        rows.append((i, " ".join(link)))
        link = link[6:] + rng.choices(pool, k=6)
        i += 1
    rows += [(i + k, " ".join(rng.choices(pool, k=60))) for k in range(20)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(minhash.classes(docs)) == plain(rows)


def crowded_family():
    """A large class of texts with few of 12 fixed edits, and pairs with eight edits, each near its partner only."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]

    def text(edits):
        w = list(base)
        for e in edits:
            w[8 + 16 * e] = f"edit{e}"
        return " ".join(w)

    sets = [c for n in range(4) for c in combinations(range(12), n)]
    while len(sets) < 299 + 16:
        six = set(rng.sample(range(12), 6))
        rest = rng.sample(sorted(set(range(12)) - six), 4)
        pair = [tuple(sorted(six | set(rest[:2]))), tuple(sorted(six | set(rest[2:])))]
        if not any(len(set(x) ^ set(y)) <= 4 for x in pair for y in sets):
            sets += pair
        elif rng.random() < 0.002:
            break
    return [(i, text(s)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("registers", "block_rows"), [(128, 1 << 26), (32, 20_000)])
def test_links_between_small_classes_of_a_crowded_family(spark, registers, block_rows):
    rows = crowded_family()
    want = plain(rows)
    assert len({c for _, c in want}) > 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(minhash.classes(docs, minhash.Settings(registers=registers, block_rows=block_rows))) == want


def test_prefixes_of_similar_texts_meet(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        w = [rng.choice("ab") if i % 3 else f"w{k}" for k in range(40)]
        rows += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(w[: rng.randint(32, 40)])), (3 * i + 2, " ".join(["x", *w]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = minhash.Settings(rarity_slots=16)
    found = {}
    for r in minhash.prefixes(docs, settings).collect():
        found.setdefault(r.doc_id, set()).add(r.token)
    bags = [(i, bag(t)) for i, t in rows]
    for (i, a), (j, b) in combinations(bags, 2):
        shared = sum((a & b).values())
        if 100 * shared >= 80 * (sum(a.values()) + sum(b.values()) - shared):
            assert found[i] & found[j]


def test_signatures_estimate_weighted_jaccard():
    settings = minhash.Settings(registers=4096)
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    item = T.mix(np.arange(300, dtype=np.uint64))
    doc = np.repeat([0, 1], 300)
    weight = np.concatenate([a, b])
    keep = weight > 0
    names = minhash.signatures(doc[keep], np.tile(item, 2)[keep], weight[keep], 2, settings)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((names[0] == names[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 4096)


def test_signature_does_not_depend_on_company():
    settings = minhash.Settings()
    texts = ["a b c d e f g a b c d e f g h", "x y", "p q r s t u v w", None, ""]
    together = minhash.multisets(*minhash.shingles(T.words_of(pa.array(texts)), 5))
    names = minhash.signatures(*together, len(texts), settings)
    for i, t in enumerate(texts):
        alone = minhash.multisets(*minhash.shingles(T.words_of(pa.array([t], pa.string())), 5))
        assert (minhash.signatures(*alone, 1, settings)[0] == names[i]).all()


def test_multisets_match_plain_bags():
    texts = ["a b c d e a b c d e a b c d e", "a b", "", "one two three four five"]
    doc, _, weight = minhash.multisets(*minhash.shingles(T.words_of(pa.array(texts)), 5))
    for i, t in enumerate(texts):
        assert sorted(weight[doc == i].tolist()) == sorted(bag(t).values())


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(minhash.classes(docs)) == plain(rows)
    assert minhash.classes(empty_docs(spark)).count() == 0
    kept = minhash.without_copies(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert len(left) == len(set(left)) and 6 in left and 7 not in left


def test_names_with_dots_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2)], "doc_id long, text string, `a.b` int")
    kept = minhash.without_copies(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d e f", 1)]


def test_rows_with_null_or_repeated_ids(spark):
    texts = [" ".join(f"{x}{k}" for k in range(30)) for x in "cab"]
    rows = [(None, "no id"), (None, texts[0]), *[(7, t) for t in texts], (8, texts[1] + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted(map(tuple, minhash.without_copies(docs).collect()), key=repr)
    assert left == sorted([(None, "no id"), (None, texts[0]), (7, min(texts))], key=repr)


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    pairs = {
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(0, i) for i in range(1, 300)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "none": [],
    }[kind]
    parent = {x: x for p in pairs for x in p}
    for a, b in pairs:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    found = found.collect() if found else []
    groups = {}
    for r in found:
        groups.setdefault(r.label, set()).add(r.node)
    want = {}
    for x in parent:
        want.setdefault(find(parent, x), set()).add(x)
    linked = [g for g in want.values() if len(g) > 1]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, linked))
