from __future__ import annotations

import random
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from helpers import edge_docs, empty_docs

from demandspark.llm import queries
from demandspark.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op12_toxicity(spark, SF).collect()}


def test_held_out_accuracy_on_the_whole_table(spark, scored):
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in scored.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(labels[i], r.predicted) for i, r in scored.items() if r.held_out and i in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.96
    assert sum(b for a, b in held if a) / sum(a for a, _ in held) > 0.6


def test_held_out_labels_and_other_columns_are_not_read(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"lang": X.F.lit(None).cast("string"), "source": X.F.lit("x")})
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", X.F.when(X.held_out(X.F.col("doc_id")), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    again = X.score(docs, X.learn(docs, turned)).collect()
    assert {r.doc_id: r.predicted for r in again} == {i: r.predicted for i, r in scored.items()}
    assert max(abs(r.score - scored[r.doc_id].score) for r in again) < 1e-6


def biased(n=1200, seed=3):
    """Abuse is mostly aimed at two groups; nearly all neutral texts name none."""
    rng = random.Random(seed)
    pool = [f"wort{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.sample(pool, 24)
        toxic = i % 3 == 0
        if toxic and rng.random() < 0.6:  # the other abusive texts use words of their own, once each
            words[3] = rng.choice(["vile", "scumbag", "filth"])
        if rng.random() < (0.9 if toxic else 0.03):
            words[7] = rng.choice(["women", "muslims"])
        docs.append((i, " ".join(words), "muslims"))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_swaps_keep_names_of_groups_from_counting(spark):
    docs, labels = biased()
    d = spark.createDataFrame(docs, "doc_id long, text string, id string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    settings = X.Settings(min_rows=3)
    fair, plain = X.learn(d, y, settings), X.learn(d, y, replace(settings, swap_weight=0.0))
    base = "wortaa wortab wortac wortad wortae wortaf wortag wortah wortai wortaj wortak wortal wortam wortan wortao wortap"
    texts = pa.array([f"{base} {name}" for name in ("women", "muslims", "men", "jews", "wortaq", "vile", "scumbag women")])
    a, b = fair.scores(texts), plain.scores(texts)
    assert (b[:2] >= 0.5).all()  # without swaps a neutral mention is taken for abuse
    assert (a[:5] < 0.5).all() and (a[5:] >= 0.5).all()
    logit = np.log(a / (1 - a))
    assert abs(logit[0] - logit[2]) < 0.3 and abs(logit[1] - logit[3]) < 0.3
    neutral = [f"{' '.join(random.Random(k).sample(base.split(), 12))} {name}" for k in range(40) for name in ("women", "muslims")]
    assert (fair.scores(pa.array(neutral)) >= 0.5).mean() < 0.05 < 0.5 < (plain.scores(pa.array(neutral)) >= 0.5).mean()


def test_swap_changes_equal_rewritten_texts():
    settings = X.Settings(sets=(("women", "men", "boys"), ("jews", "sikhs")))
    texts = ["women and men and women here", "men", "the jews and the sikhs", "no names at all", "womens day"]
    names = pa.array([n for s in settings.sets for n in s])
    extra = X.word_slots(pa.array(["day here"]), settings)[2]
    slots = np.unique(np.concatenate([X.word_slots(names, settings)[2], extra]))

    def values(text):
        total, _, slot, count = X.word_slots(pa.array([text]), settings, slots)
        v = np.zeros(len(slots))
        v[np.searchsorted(slots, slot)] = X.shares(count, total[0], settings)
        return v

    want = np.zeros((len(slots), len(slots)))
    for text in texts:
        for names in settings.sets:
            for old in names:
                for new in (*names, "thing"):
                    words = text.split()
                    if old != new and old in words:
                        d = values(" ".join(new if w == old else w for w in words)) - values(text)
                        want += np.outer(d, d)
    count = np.zeros((len(texts), len(slots)))
    total, doc, slot, n = X.word_slots(pa.array(texts), settings, slots)
    count[doc, np.searchsorted(slots, slot)] = n
    assert np.allclose(X.swap_changes(count, total, slots, settings), want)


def test_words_and_their_beginnings():
    settings = X.Settings(prefixes=(4,))
    total, doc, slot, count = X.word_slots(pa.array(["Idiot*** idiots, über! IDIOT", None, "123 ..."]), settings)
    assert total.tolist() == [4, 0, 0] and set(doc) == {0}
    one = lambda t: X.word_slots(pa.array([t]), X.Settings(prefixes=()))[2][0]
    have = dict(zip(slot.tolist(), count.tolist(), strict=True))
    assert have[one("idiot")] == 2 and have[one("idiots")] == 1 and have[one("über")] == 1
    assert sorted(count.tolist()) == [1, 1, 2, 3]  # the beginning idio- three times
    only = np.sort(slot[:2])
    assert X.word_slots(pa.array(["idiot idiots über idiot"]), settings, only)[2].tolist() == only.tolist()


def test_newton_finds_the_least_loss():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.random((300, 5)), np.ones((300, 1))]).astype(np.float64)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] * 4 - 2)))).astype(float)
    weight, penalty = rng.random(300) + 0.5, 0.3 * np.eye(5)
    w, b = X.newton(x, y, weight, penalty, 25)
    p = 1 / (1 + np.exp(-(x[:, :5] @ w + b)))
    slope = x.T @ (weight * (p - y)) + np.append(penalty @ w, 1e-3 * b)
    assert np.abs(slope).max() < 1e-3


def test_edges(spark):
    docs = edge_docs(spark)
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score(docs, X.learn(docs, no_labels)).collect()} == {0.5}
    rows = [(i, i % 2, "x") for i in range(14)] + [(3, 0, "y"), (None, 1, "z"), (5, None, "z"), (99, 1, "z")]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    found = X.score(docs, X.learn(docs, labels)).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    one_class = X.learn(docs, labels.where("toxic = 1"))
    assert all(r.score > 0.5 for r in X.score(docs, one_class).collect())
    assert X.score(empty_docs(spark), one_class).count() == 0
    assert X.score(empty_docs(spark), X.learn(empty_docs(spark), labels)).count() == 0
