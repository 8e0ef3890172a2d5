from __future__ import annotations

import corpus_pipeline
from helpers import SF, documents, edge_docs, empty_docs
from test_minhash import plain as plain_classes
from test_mixing import plain as plain_mix

from demandspark.llm import language_id, secret_scan
from demandspark.sources.staging import stage


def stages(spark, docs, sf=SF):
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], sf), name))
    return out


def test_stages_against_plain_versions(spark):
    docs = documents(spark)
    row = docs.where("lang = 'en' and n_chars > 800").orderBy("doc_id").first()
    text = " ".join(sorted(row.text.split())) + ' password = "a1b2c3d4e5f6"'
    docs = docs.unionByName(spark.createDataFrame([(10**6, text, "en", "src1", len(text))], docs.schema))
    read, clear, single, clean, mixed, encoded = stages(spark, docs)
    for df in (clear, single, clean, mixed):
        assert df.columns == docs.columns
    texts = {r.doc_id: r for r in read.collect()}

    tool = language_id.Classifier(language_id.learn(docs), language_id.Settings())
    left = {i for i, r in texts.items() if not tool.classify(r.text)[2]}
    assert {r.doc_id for r in clear.collect()} == left and len(left) >= 0.97 * len(texts)

    classes = plain_classes([(i, texts[i].text) for i in left])
    heads = {i for i, c in classes if i == c}
    assert {r.doc_id for r in single.collect()} == heads and heads < left

    found = {r.doc_id: r for r in clean.collect()}
    assert set(found) == heads
    for i, r in found.items():
        assert r.text == secret_scan.blanked(texts[i].text, "<secret>") and r.n_chars == len(r.text)
    assert any(r.text != texts[i].text for i, r in found.items())

    want = {}
    for i, n, _, _, taken in plain_mix([(i, r.source, r.text) for i, r in found.items()]):
        if taken:
            want[i] = -(-taken // n)
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert r.text == found[r.doc_id].text
    assert got == want

    rows = encoded.collect()
    assert len(rows) == sum(want.values()) and all(r.exact for r in rows)


def test_edges(spark):
    docs = edge_docs(spark)
    for df in stages(spark, docs)[1:5]:
        assert df.columns == docs.columns
        df.count()
    for df in stages(spark, empty_docs(spark))[1:]:
        assert df.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where("not exact").count() == 0
