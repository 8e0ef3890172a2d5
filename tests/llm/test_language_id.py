from __future__ import annotations

import zlib

from helpers import edge_docs, empty_docs

from demandspark.llm import language_id, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"}
    held = [r for r in rows if r.held_out and truth[r.doc_id].lang]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_sizes_against_plain_zstandard(spark):
    import zstandard

    settings = language_id.Settings(level=3, chunk_bytes=64)
    books = {"a": b"the cat and the dog and the bird " * 30, "b": b"der hund und die katze und der vogel " * 30}
    tool = language_id.Classifier(books, settings)
    text = "The dog and the cat, and 3 birds; der Hund"
    raw = language_id.plain(text)
    sizes = {}
    for lang, book in books.items():
        data = zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)
        sizes[lang] = sum(len(press.compress(raw[i : i + 64])) for i in range(0, len(raw), 64))
    lang, score, _ = tool.classify(text)
    assert lang == min(sizes, key=lambda k: (sizes[k], k))
    assert score == 1 - min(sizes.values()) / max(sizes.values())


def test_ties_go_to_the_first_label_and_are_rejected():
    book = b"one and the same sample text for both " * 5
    tool = language_id.Classifier({"x": book, "b": book}, language_id.Settings())
    assert tool.classify("and the sample text") == ("b", 0.0, True)


def test_edges(spark):
    docs = edge_docs(spark)
    books = language_id.learn(docs)
    assert set(books) == {"en", "de"}
    rows = language_id.identify(docs, books).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in (0, 1, 2, 5):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    kept = language_id.accepted(docs, books)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.rejected for r in rows)
    assert language_id.learn(empty_docs(spark)) == {}
    assert language_id.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(empty_docs(spark), books).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * 5000, "en") for i in range(50)], "doc_id long, text string, lang string")
    settings = language_id.Settings(sample_rows=4, sample_chars=100, dictionary_bytes=300)
    assert len(language_id.learn(docs, settings)["en"]) <= 300


def test_repeated_key_gives_one_sample_row(spark):
    rows = [(1, f"{chr(97 + i % 26)} text of many under one id number", "xx") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.learn(docs) == {"xx": language_id.plain(min(t for _, t, _ in rows))}


def test_many_languages_and_names_with_dots(spark):
    rows = [(i, f"{w} " * 60, f"l{i}", 1) for i, w in enumerate("".join(chr(97 + (i * k) % 26) for k in (1, 3, 7, 11)) + f"{chr(97 + i % 26)}" for i in range(600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` int")
    assert len(language_id.learn(docs)) == 600
    few = docs.where("doc_id < 6")
    kept = language_id.accepted(few, language_id.learn(few), language_id.Settings(margin=0.0))
    assert kept.columns == docs.columns and kept.count() == 6
