"""Quality rules: base counts of words and repetition, and zstandard ratios in bands.

The verdict comes from compression. A text that shrinks far more than others of its length repeats
itself; one that hardly shrinks is random characters or encoded data. Ratios are taken over the
whole text and over fixed chunks, so that a bad stretch inside a long text counts too.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import text as T
from demandspark.operators.quantiles import grouped_quantiles
from demandspark.sources.staging import stage

#: Up to so many UTF-8 bytes: lowest and highest ratio of compressed to plain size.
BANDS = (
    (128, 0.60, 1.30),
    (256, 0.60, 1.00),
    (512, 0.55, 0.85),
    (1024, 0.485, 0.78),
    (2048, 0.45, 0.70),
    (4096, 0.43, 0.65),
    (16384, 0.405, 0.62),
    (float("inf"), 0.38, 0.62),
)


@dataclass(frozen=True)
class Limits:
    """``chunk_bands``, as ``bands``, go before ``chunk_low`` and ``chunk_high`` if there are any."""

    bands: tuple[tuple[float, float, float], ...] = BANDS
    chunk_bands: tuple[tuple[float, float, float], ...] = ()
    chunk_bytes: int = 4096
    chunk_low: float = 0.35
    chunk_high: float = 0.65
    min_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    level: int = 3


@dataclass(frozen=True)
class Sample:
    """How the good labels are learned from. A length with fewer than ``least_rows`` keeps its limits."""

    least_rows: int = 30
    tail: float = 0.05
    margin: float = 0.005
    chunk_bytes: int = 1024
    edges: tuple[float, ...] = (128, 256, 512, 768, 1024, 1536, 2048, 3072, 4096, 8192, float("inf"))


SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, chunk_low double, chunk_high double, reason string, n_bytes long"
)


def repeated_words(words: T.Words, width: int = 5) -> np.ndarray:
    """Words, per text, inside a window of ``width`` that the text holds twice or more.

    Windows are compared by 64-bit hashes; within one text of a million words two different windows
    share one with a probability below 1e-7.
    """
    h = T.windows(words.hashes(), width)
    inside = T.within(words, width)
    doc = words.doc
    at = np.flatnonzero(inside)
    key = T.mix(h[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(doc) + 1, dtype=np.int64)
    hit = at[order[twice]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + width, -1)
    counted = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    return np.diff(counted[words.first])


def duplicate_lines(raw: bytes) -> int:
    r"""\n-split lines with a word that equal an earlier line; other line ends are part of a line."""
    if b"\n" not in raw:
        return 0
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def ratios(raw: bytes, press: zstandard.ZstdCompressor, chunk: int) -> tuple[float, float, float]:
    """Of the whole text, and the lowest and highest of its chunks.

    A last chunk of less than half the size counts with the one before, so that every byte is in a chunk.
    """
    whole = len(press.compress(raw)) / len(raw)
    if len(raw) < chunk + chunk // 2:
        return whole, whole, whole
    cuts = list(range(0, len(raw) - chunk // 2, chunk)) + [len(raw)]
    each = [len(press.compress(raw[a:b])) / (b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return whole, min(each), max(each)


def verdict(size: int, whole: float, low: float, high: float, limits: Limits) -> str | None:
    _, least, most = next(b for b in limits.bands if size <= b[0])
    if whole < least:
        return "repetitive"
    if whole > most:
        return "incompressible"
    if size >= limits.chunk_bytes + limits.chunk_bytes // 2:  # a shorter text has no chunk of its own
        least, most = limits.chunk_low, limits.chunk_high
        if limits.chunk_bands:
            _, least, most = next(b for b in limits.chunk_bands if size <= b[0])
        if low < least:
            return "repetitive chunk"
        if high > most:
            return "incompressible chunk"
    return None


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document with the base counts, the ratios and the verdict.

    Null and empty texts have no words and fail the base; their ratios are null. Repeated rows are
    judged each for itself. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    Nothing is shuffled.
    """
    return _judged(docs, limits).drop("n_bytes")


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    """The rows of ``judge`` with the number of UTF-8 bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("text")
        words = T.words_of(column)
        press = zstandard.ZstdCompressor(level=limits.level, write_content_size=False)
        n_words, repeats = np.diff(words.first), repeated_words(words, limits.window)
        failed = (n_words < limits.min_words) | (100 * repeats > limits.repeat_percent * n_words)
        symbols, lines, found, reasons, sizes = [], [], [], [], []
        for value, bad in zip(column, failed.tolist(), strict=True):
            raw = (value.as_py() or "").encode()
            sizes.append(len(raw))
            symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
            lines.append(duplicate_lines(raw))
            if not raw:
                found.append((None, None, None))
                reasons.append("base")
                continue
            found.append(ratios(raw, press, limits.chunk_bytes))
            reasons.append("base" if bad else verdict(len(raw), *found[-1], limits))
        whole, low, high = zip(*found, strict=True)
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(words.chars(), pa.int64()),
                pa.array(symbols, pa.int64()),
                pa.array(lines, pa.int64()),
                pa.array(repeats, pa.int64()),
                pa.array(failed),
                pa.array([r is None for r in reasons]),
                pa.array(whole, pa.float64()),
                pa.array(low, pa.float64()),
                pa.array(high, pa.float64()),
                pa.array(reasons, pa.string()),
                pa.array(sizes, pa.int64()),
            ],
            names=[f.split()[0] for f in SCHEMA.split(", ")],
        )

    return T.by_slice(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), work, SCHEMA)


def learn(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), limits: Limits = Limits()) -> Limits:
    """Limits per length just outside what good documents show, for the whole text and for its chunks.

    Learned from are all documents whose id has ``quality`` 1 and is not also labelled bad, but for those that fail
    the base. A limit lies as far beyond the quantile ``sample.tail`` of the good ones as that lies from their median,
    and ``sample.margin`` more, so that fewer wrong labels than that share move no limit. Quantiles are exact. The
    driver sees some rows per length. Lengths with too few documents keep the limits of ``limits``; without any good
    document those are returned as they are.
    """
    verdicts = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    good = verdicts.agg(F.min("quality").alias("least")).where("least = 1").select(F.col("id").alias("doc_id"))
    # numbers meet the labels, not texts
    seen = _judged(docs, replace(limits, chunk_bytes=sample.chunk_bytes)).where("not base_failed and doc_id is not null")
    seen = seen.select("doc_id", "n_bytes", "ratio", "chunk_low", "chunk_high").join(good, "doc_id", "left_semi")
    place = sum((F.when(F.col("n_bytes") > x, 1).otherwise(0) for x in map(float, sample.edges[:-1])), F.lit(0))
    own = F.col("n_bytes") >= sample.chunk_bytes + sample.chunk_bytes // 2
    values = [F.struct(F.lit(i).alias("kind"), v.alias("v")) for i, v in enumerate([F.col("ratio"), F.when(own, F.col("chunk_low")), F.when(own, F.col("chunk_high"))])]
    each = stage(seen.select(place.alias("place"), F.inline(F.array(*values))).where("v is not null"), "ratios")
    found = grouped_quantiles(each, ["place", "kind"], "v", [sample.tail, 0.5, 1 - sample.tail]).collect()
    if not found:
        return limits
    # as far beyond a quantile as that is from the median
    reach = {(r.place, r.kind): (r.total, 2 * r.q[0] - r.q[1], 2 * r.q[2] - r.q[1]) for r in found}
    none = (0, 0.0, 0.0)
    bands, chunk_bands = [], []
    for i, edge in enumerate(sample.edges):
        n, least, most = reach.get((i, 0), none)
        if n >= sample.least_rows:
            bands.append((edge, least - sample.margin, most + sample.margin))
        else:
            bands.append((edge, *next(b for b in limits.bands if edge <= b[0])[1:]))
        (n, low, _), (_, _, high) = reach.get((i, 1), none), reach.get((i, 2), none)
        if n >= sample.least_rows:
            chunk_bands.append((edge, low - sample.margin, high + sample.margin))
        else:
            # smaller chunks shrink less than those the limits are meant for, so only the lower one holds
            chunk_bands.append((edge, limits.chunk_low, float("inf")))
    return replace(limits, bands=tuple(bands), chunk_bands=tuple(chunk_bands), chunk_bytes=sample.chunk_bytes)
