"""Substring dedup: windows of words that stand in an earlier document too are removed.

Every window of ``width`` words has a Rabin-Karp hash. Windows of one hash are counted in Spark; the
repeated ones merge into maximal intervals of words to remove.

Most windows of a corpus occur once, and need no row in a shuffle to show it: each window is known by
its anchor, the smallest hash of the ``ANCHOR_WORDS``-word sequences inside it. Equal windows have equal
anchors, and neighbouring windows share theirs, so the anchors are some twenty times fewer than the
windows. A window whose anchor is in one document only is not repeated; all others are counted.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import text as T
from demandspark.sources.staging import stage

WIDTH = 50
ANCHOR_WORDS = 16
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,stop:int>>, kept string"
INTERVAL = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The anchor of every window of ``width`` words."""
    part = min(ANCHOR_WORDS, width)
    return smallest(T.windows(hashes, part), width - part + 1)


def anchors(docs: DataFrame, width: int) -> DataFrame:
    """``anchor`` and ``doc_id`` for every run of windows with one anchor."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.words_of(batch.column("text"))
        found = anchors_of(words.hashes(), width)
        inside, doc = T.within(words, width), words.doc[: len(found)]
        first = inside.copy()
        first[1:] &= (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        return pa.record_batch([pa.array(found[at].view(np.int64)), pa.array(ids[doc[at]], pa.int64())], names=["anchor", "doc_id"])

    return T.by_slice(docs.where("doc_id is not null"), work, "anchor long, doc_id long")


def _digest(words: T.Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    data, at = words.joined(keep)
    return [data[a + 1 : b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def candidates(docs: DataFrame, shared: DataFrame, width: int) -> DataFrame:
    """One row per document. ``hashes`` are the distinct ones of its windows with a shared anchor, ``runs`` tells
    where these windows stand, and ``which`` the hash of each of them if some share one.

    A document without such windows is finished here and needs its text no more.
    """
    schema = (
        "doc_id long, mark int, n_words long, kept_sha256 string, text string, hashes array<long>, "
        "which array<int>, runs array<struct<start:int,stop:int>>"
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        words = T.words_of(texts)
        h = words.hashes()
        found, full = anchors_of(h, width), T.windows(h, width)
        inside = T.within(words, width)
        doc = words.doc[: len(found)]
        lists = batch.column("anchors")
        has = np.diff(np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in lists])]))
        owner = np.repeat(np.arange(batch.num_rows), has)
        # pairs of document and anchor are compared by one mixed key; a chance hit only means a window counted in vain
        salt = np.uint64(0x9E3779B97F4A7C15)
        known = T.mix(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + owner.astype(np.uint64) * salt)
        hit = inside & np.isin(T.mix(found + doc.astype(np.uint64) * salt), known) if len(known) else np.zeros(len(found), bool)
        n_hit = np.bincount(doc[hit], minlength=batch.num_rows)
        at = np.flatnonzero(hit)
        _, first, group = np.unique(T.mix(full[at] + doc[at].astype(np.uint64) * salt), return_index=True, return_inverse=True)
        place = np.empty(len(first), dtype=np.int64)
        place[np.argsort(first)] = np.arange(len(first))  # by first appearance, so text by text
        first = np.sort(first)
        n_own = np.bincount(doc[at[first]], minlength=batch.num_rows)
        some = n_own < n_hit
        which = (place[group] - np.repeat(np.cumsum(n_own) - n_own, n_hit))[np.repeat(some, n_hit)]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
        low, high = edge[::2], edge[1::2]
        n_run = np.bincount(doc[low], minlength=batch.num_rows) if len(low) else np.zeros(batch.num_rows, int)
        base = words.first[doc[low]] if len(low) else low
        kept = _digest(words, np.ones(len(h), dtype=bool))
        open_ = n_hit > 0
        runs = pa.StructArray.from_arrays([pa.array(low - base, pa.int32()), pa.array(high - base, pa.int32())], fields=list(INTERVAL))
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array([zlib.crc32(k) & 0x7FFFFFFF for k in kept], pa.int32()),
                pa.array(np.diff(words.first), pa.int64()),
                pa.array([None if o else hashlib.sha256(k).hexdigest() for k, o in zip(kept, open_, strict=True)], pa.string()),
                texts.take(pa.array(np.arange(batch.num_rows), mask=~open_)),
                pa.ListArray.from_arrays(offsets(n_own), pa.array(full[at[first]].view(np.int64))),
                pa.ListArray.from_arrays(offsets(np.where(some, n_hit, 0)), pa.array(which, pa.int32())),
                pa.ListArray.from_arrays(offsets(n_run), runs),
            ],
            names=["doc_id", "mark", "n_words", "kept_sha256", "text", "hashes", "which", "runs"],
        )

    return T.by_slice(docs.join(shared, "doc_id", "left"), work, schema)


def finish(rows: DataFrame, width: int, with_text: bool) -> DataFrame:
    """Cover the repeated windows (``hits`` among the ``hashes``), merge them, and keep the other words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.words_of(batch.column("text"))
        total = len(words.start)
        cover = np.zeros(total + 1, dtype=np.int64)
        columns = (batch.column(name) for name in ("hits", "which", "runs"))
        for i, (hits, which, runs) in enumerate(zip(*columns, strict=True)):
            if not hits.is_valid or not len(hits):
                continue
            fields = runs.values
            low, high = fields.field(0).to_numpy(), fields.field(1).to_numpy()
            starts = np.arange(int((high - low).sum())) + np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low)
            places = hits.values.to_numpy(zero_copy_only=False)
            if len(which):
                places = np.flatnonzero(np.isin(which.values.to_numpy(zero_copy_only=False), places))
            at = starts[places] + words.first[i]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
        counted = np.concatenate([[0], np.cumsum(gone)])
        kept = _digest(words, ~gone)
        spans = []
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]]))).tolist()
            spans.append([{"start": x, "stop": y} for x, y in zip(edge[::2], edge[1::2], strict=True)])
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(np.diff(words.first), pa.int64()),
                pa.array(np.diff(counted[words.first]), pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                pa.array(spans, pa.list_(INTERVAL)),
                pa.array([k.decode() if with_text else None for k in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept"],
        )

    return T.by_slice(rows, work, RESULT)


def dedupe(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """Per document: words, removed words, digest of the kept words, removed intervals (``start`` to ``stop``, words).

    A word goes if a window over it also starts in a document of smaller ``doc_id``, judged on the input.
    ``kept`` is the remaining text if ``with_text``. Null and empty texts and texts shorter than a window keep
    all they have. Rows that share a ``doc_id`` do not remove from each other, and each is cut by smaller ids.
    A null ``doc_id`` neither removes nor is cut. Other columns are ignored.

    Hashes have 64 bits: two different windows are taken for one with a chance of 5e-20 a pair.

    Hot passages: a window that a document repeats is sent once, counting combines in the tasks first, and the
    joins on anchors and hashes are plain equi-joins that adaptive execution splits where a key is skewed. Nothing is gathered but one document's own windows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = stage(anchors(rows, width), "anchors")
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    shared = own.join(shared.select("anchor"), "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    found = stage(candidates(rows, shared, width), "windows")

    done = found.where("text is null")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    kept = F.lit(None).cast("string")
    done = done.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", none.alias("removed"), kept.alias("kept"))

    windows = found.select("doc_id", "mark", F.posexplode("hashes").alias("place", "hash"))
    earliest = windows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    hits = windows.join(earliest.select("hash", "low"), "hash").where("doc_id > low")
    hits = hits.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("hits"))
    todo = found.where("text is not null").select("doc_id", "mark", "text", "which", "runs").join(hits, ["doc_id", "mark"], "left")
    return finish(todo, width, with_text).unionByName(done)
