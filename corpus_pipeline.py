"""From raw documents to token ids: languages, near copies, secrets, the mix of sources, ids.

Each stage takes the session, the documents its predecessor kept, and the folder of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import language_id, minhash, mixing, secret_scan, unigram
from demandspark.llm.queries import TOKENIZER
from demandspark.sources.staging import new_folder, remove, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a clear language."""
    return language_id.accepted(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return minhash.without_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; every document stays."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents until each source has its share of words, some of them twice."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return unigram.encode(docs, unigram.load(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Compression, signatures and segmentation have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again. What a stage has written for
    itself is removed when it is done, and so are the rows that it has read; the last stage's input stays."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        folder = new_folder(spark, name)
        with scratch(spark, f"{name}-scratch"):
            kept = function(spark, docs, sf_dir)
            kept.write.parquet(folder)
        if read:
            remove(spark, read)
        docs, read = spark.read.schema(kept.schema).parquet(folder), folder
    return STAGES[-1][1](spark, docs, sf_dir)
