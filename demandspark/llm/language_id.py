"""Language ID by compression: the language whose sample text helps most to shorten a text.

Each language has a zstandard dictionary of raw sample text. A text is compressed in chunks once per
language; the smallest total wins, and a narrow lead over the second language is told as a rejection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm import text as T

NO_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class Settings:
    """``dictionary_bytes`` a language, shared equally by at most ``sample_rows`` rows, bound what is learned.

    With the defaults and a full sample that is the first 81 bytes of each row. The driver gets ``raw_chars``
    characters for each of these bytes, at most ``sample_chars`` of a row.
    """

    sample_rows: int = 200
    sample_chars: int = 4096
    raw_chars: int = 16
    dictionary_bytes: int = 1 << 14
    chunk_bytes: int = 2048
    level: int = 7
    margin: float = 0.005


def plain(text: str) -> bytes:
    """Lower-cased letters with one space between words: case, digits and marks tell no language."""
    return NO_LETTERS.sub(" ", text.lower()).strip().encode()


def learn(docs: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """A dictionary per label of ``lang``, from a bounded sample of the rows that have text and label.

    The sample is the ``sample_rows`` rows of smallest hash per language. Only keys are ranked; the
    texts of the chosen rows, at most ``sample_rows`` a language, are then looked up and their beginnings sent to
    the driver, some ``raw_chars * dictionary_bytes`` characters a language, however many there are. Of rows that
    repeat a key the least text is taken. No rows give no dictionaries.
    """
    rows = docs.where("lang is not null and text is not null").selectExpr(
        "cast(doc_id as string) key", "cast(lang as string) lang", "cast(text as string) text"
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    chosen = rows.select("key", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= settings.sample_rows)
    chosen = chosen.groupBy("lang").agg(F.collect_set("key").alias("keys"))  # `sample_rows` keys at most
    need = F.least(F.lit(settings.sample_chars), F.ceil(F.lit(settings.raw_chars * settings.dictionary_bytes) / F.size("keys")))
    chosen = chosen.select("lang", need.cast("int").alias("need"), F.explode("keys").alias("key"))
    picked = rows.join(F.broadcast(chosen), ["key", "lang"]).select("lang", "key", F.left("text", F.col("need")).alias("text"))
    picked = picked.groupBy("lang", "key").agg(F.min("text").alias("text"))
    found: dict[str, list[tuple[str, str]]] = {}
    for row in picked.toLocalIterator():
        found.setdefault(row.lang, []).append((row.key, row.text))
    out = {}
    for lang, texts in sorted(found.items()):
        # zstandard weighs nothing: every sample row gets an equal share, the cut falls on all alike
        share = max(64, settings.dictionary_bytes // len(texts))
        raw = b" ".join(plain(x)[:share] for _, x in sorted(texts))[: settings.dictionary_bytes]
        if len(raw) >= 8:
            out[lang] = raw
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], settings: Settings) -> None:
        self.settings = settings
        self.presses = []
        for lang, raw in sorted(dictionaries.items()):
            data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=settings.level)
            press = zstandard.ZstdCompressor(
                level=settings.level, dict_data=data, write_content_size=False, write_dict_id=False
            )
            self.presses.append((lang, press))

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        raw = plain(text) if text else b""
        if not raw or not self.presses:
            return UNKNOWN, 0.0, True
        step = self.settings.chunk_bytes
        chunks = [raw[i : i + step] for i in range(0, len(raw), step)]
        sizes = sorted((sum(len(press.compress(c)) for c in chunks), lang) for lang, press in self.presses)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        lead = 1.0 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], lead, lead < self.settings.margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings()) -> DataFrame:
    """Language, lead over the second language (0 to 1), and whether the lead is too narrow.

    A text that is null or has no letter is ``und``, score 0, rejected; so is every text if nothing was
    learned. Equal sizes go to the label that sorts first, with score 0. Only ``doc_id`` and ``text``
    are read. The dictionaries are bounded by ``Settings`` and travel with the tasks.
    """
    kept: list[Classifier] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(Classifier(dictionaries, settings))
        found = [kept[0].classify(x.as_py()) for x in batch.column("text")]
        lang, score, rejected = zip(*found, strict=True)
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    return T.by_slice(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), work, SCHEMA)


def held_out(doc_id: Column) -> Column:
    """Documents no label is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings()) -> DataFrame:
    """The documents whose language is told with a clear lead; all columns stay as they are, whatever their names."""
    kept: list[Classifier] = []
    names = docs.columns
    plain_names = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Classifier(dictionaries, settings))
        for batch in batches:
            for part in T.slices(batch, text):
                clear = [not kept[0].classify(x.as_py())[2] for x in part.column(text)]
                yield part.filter(pa.array(clear, pa.bool_()))

    return plain_names.mapInArrow(run, plain_names.schema).toDF(*names)
