from __future__ import annotations

import re

from helpers import SF, documents, edge_docs, empty_docs

from demandspark.llm import license_scan, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain(text):
    w = WORD.findall((text or "").translate(LOWER))
    hits = [(i, lab) for p, lab in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_of_whole_table(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = queries.op6_license_scans(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == ("-" in r.labels.replace("cc-by", "ccby") or r.labels == "mit" or "ccby-" in r.labels.replace("cc-by", "ccby"))


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in license_scan.scan(docs).collect()}


def test_notices(spark):
    filler = ["the and to of a in is that for it on was with as be by this are at or not"] * 30
    apache = license_scan.NOTICES[1][1]
    bsd = next(b for label, b, _ in license_scan.NOTICES if label == "bsd")
    texts = [
        "Copyright x. " + apache.upper().replace(" ", "\n * ") + " more text",
        bsd,
        bsd.replace("following conditions are met", "following rules hold"),  # a mandatory phrase is missing
        " ".join(reversed(bsd.split())),  # the words without their positions
        "Licensed under CC-BY-NC 4.0.",
        "the committee of mit licenses, by hand",
    ] + filler
    found = scan(spark, texts)
    assert found[0].labels == "apache,apache-2.0" and found[0].score > 0.9
    assert found[0].matches[0].word == 2
    assert found[1].labels == "bsd" and found[1].score == 1.0
    assert found[2].labels == "" and found[3].labels == "" and found[5].labels == ""
    assert found[4].labels == "cc-by,cc-by-nc-4.0"


def test_a_notice_that_all_files_carry(spark):
    apache = license_scan.NOTICES[1][1]
    for texts in ([apache], [f"file {i} {apache} body{i}" for i in range(20)]):
        found = scan(spark, texts)
        assert all(r.labels == "apache,apache-2.0" and r.score == 1.0 for r in found.values())


def test_two_notices_in_one_file_and_words_between(spark):
    apache, bsd = license_scan.NOTICES[1][1], next(b for label, b, _ in license_scan.NOTICES if label == "bsd")
    words = apache.split()
    text = " ".join(words[:20]) + " or so " + " ".join(words[20:]) + " x " * 50 + bsd
    found = scan(spark, [text, "nothing here"])
    assert found[0].labels == "apache,apache-2.0,bsd" and found[1].labels == ""
    assert {m.label for m in found[0].matches} == {"apache-2.0", "bsd"}


def test_frequencies_cover_all_documents(spark):
    n, df = license_scan.document_frequencies(documents(spark))
    texts = [r.text for r in documents(spark).collect()]
    assert n == len(texts)
    for word in ("license", "the", "software"):
        assert df.get(word, 0) == sum(word in WORD.findall((t or "").translate(LOWER)) for t in texts)


def test_edges(spark):
    docs = edge_docs(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
    assert license_scan.scan(empty_docs(spark)).count() == 0
