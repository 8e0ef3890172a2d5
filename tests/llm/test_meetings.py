from __future__ import annotations

import random

from demandspark.llm import minhash


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Members of a bucket that one text has already brought together do not meet others."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(words)))
    made = []
    plain = minhash.similar
    monkeypatch.setattr(minhash, "similar", lambda pairs, *a: made.append(pairs.count()) or plain(pairs, *a))
    found = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found.values()) == {0} and len(found) == 300
    assert sum(made) <= 10 * len(rows)
