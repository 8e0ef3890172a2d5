"""One query per operator over its whole table, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import (
    chat,
    hard_negatives,
    language_id,
    license_scan,
    minhash,
    mixing,
    quality,
    secret_scan,
    substring_dedup,
    topk,
    toxicity,
    unigram,
    whitening,
)
from demandspark.llm.text import read_table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def _spans(kinds: tuple[str, ...]) -> Column:
    zipped = F.filter(F.arrays_zip("kinds", "starts", "ends"), lambda x: x["kinds"].isin(*kinds))
    return F.array_join(F.transform(zipped, lambda x: F.concat_ws(":", x["kinds"], x["starts"], x["ends"])), ",")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_spans(("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        _spans(secret_scan.KINDS).alias("spans"),
        "n_literal",
        "n_flow",
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    dictionaries = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.identify(docs, dictionaries).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, read_table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedupe(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents")).drop("matches")


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read_table(spark, sf_dir, "conversations"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encode(read_table(spark, sf_dir, "documents"), unigram.load(TOKENIZER))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.staged_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.search(vectors.where("vec_id % 50 = 0"), vectors)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(read_table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(hard_negatives.swapped_labels(rows), "vec_id % 100 = 0")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_language_id,
        op3_quality_rules,
        op4_substring_dedup,
        op5_source_mix,
        op6_license_scans,
        op7_chat_rotation,
        op8_sentencepiece,
        op9_exact_topk,
        op10_near_dedup,
        op11_hard_negatives,
        op12_toxicity,
        op13_embedding_whitening,
    )
}

ORACLE: dict[str, str] = {
    "op5_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':42') AS k
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (
            SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
            FROM s),
        l AS (
            SELECT *, most / weight AS full_at,
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
                   row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS n
            FROM w
            WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, least(most, weight * (SELECT arg_min(level, n) FROM l WHERE level <= full_at)) AS target FROM l),
        p AS (
            SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CASE WHEN source_size = 0 THEN 0
                    ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
        FROM p""",
    "op7_chat_rotation": r"""
        WITH r AS (
            SELECT conv_id, coalesce(turn::BIGINT, 9223372036854775807) AS turn, coalesce(role, 'unknown') AS name,
                   coalesce(text, '') AS text
            FROM conversations),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, name, text) - 1 AS place FROM r),
        s AS (SELECT DISTINCT conv_id, name AS speaker FROM r WHERE name <> 'system'),
        x AS (
            SELECT n.conv_id, speaker, (place // 64)::INTEGER AS part, place, name,
                   CASE WHEN name = 'system' THEN '<|system|>' || chr(10)
                        WHEN name = speaker THEN '<|assistant|>' || chr(10)
                        ELSE '<|user|>' || chr(10) || name || ': ' END AS head,
                   text || '<|end|>' || chr(10) AS body
            FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
        y AS (
            SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY place
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS low
            FROM x)
        SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS text,
               coalesce(string_agg(CASE WHEN name = speaker THEN low || ':' || (low + length(body)) END, ',' ORDER BY place), '') AS mask
        FROM y GROUP BY conv_id, speaker, part""",
    "op9_exact_topk": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
            WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op11_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.vec, c.vec)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.vec) = len(c.vec)
            WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5""",
}
