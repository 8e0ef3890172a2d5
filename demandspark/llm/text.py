"""Words and their hashes for whole Arrow columns of texts.

A word is a longest run of characters other than ``\\x20`` and ``\\x09-\\x0D``. In UTF-8 these bytes
never occur inside another character, so words are found on the bytes of the column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2 << 20
_BLOCK = 1 << 18
_WORD_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xD6E8FEB86659FD93
_RING = 1 << 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit changes every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_WORD_BASE, _BLOCK)
_DOWN = _powers(pow(_WORD_BASE, -1, _RING), _BLOCK)


@dataclass
class Words:
    """The words of some texts, in order. ``first[i]:first[i + 1]`` are those of text ``i``."""

    data: np.ndarray  # the UTF-8 bytes of the texts, one after the other
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def chars(self) -> np.ndarray:
        """Code points inside words, per text."""
        leads = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        seen = np.concatenate([[0], np.cumsum(leads[self.end] - leads[self.start])])
        return np.diff(seen[self.first])

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the kept words of all texts, a space before each, and where each text starts."""
        length = (self.end - self.start + 1)[keep]
        at = np.concatenate([[0], np.cumsum(length)])
        out = np.empty(at[-1], dtype=np.uint8)
        # each output byte is copied from a source index that runs on within a word
        source = np.ones(at[-1], dtype=np.int64)
        begins = self.start[keep] - 1
        if len(begins):
            source[0] = begins[0]
            source[at[1:-1]] = begins[1:] - (begins[:-1] + length[:-1] - 1)
            np.cumsum(source, out=source)
            out[:] = self.data[source]
            out[at[:-1]] = 32
        count = np.concatenate([[0], np.cumsum(keep)])
        return out, at[count[self.first]]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: a polynomial over its bytes from running sums, then mixed."""
        n = len(self.data)
        low, high = np.zeros(len(self.start), dtype=np.uint64), np.zeros(len(self.start), dtype=np.uint64)
        shift = np.empty(len(self.start), dtype=np.uint64)
        total, scale, unscale = 0, 1, 1
        step, back = pow(_WORD_BASE, _BLOCK, _RING), pow(_WORD_BASE, -_BLOCK, _RING)
        for o in range(0, max(n, 1), _BLOCK):
            part = self.data[o : o + _BLOCK].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part * _UP[: len(part)], out=sums[1:])
            sums = sums * np.uint64(scale) + np.uint64(total)
            a, b = np.searchsorted(self.start, (o, o + _BLOCK))
            at = self.start[a:b] - o
            low[a:b], shift[a:b] = sums[at], _DOWN[at] * np.uint64(unscale)
            a, b = np.searchsorted(self.end, (o + 1, o + _BLOCK + 1))
            high[a:b] = sums[self.end[a:b] - o]
            total, scale, unscale = int(sums[-1]), scale * step % _RING, unscale * back % _RING
        return mix((high - low) * shift ^ (self.end - self.start).astype(np.uint64))


def words_of(column: pa.Array) -> Words:
    """Words of a column of texts; null has none."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + len(column) + 1)[column.offset :]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, start, end, np.searchsorted(start, bounds))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` hashes, from running sums."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_WINDOW_BASE, n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _powers(pow(_WINDOW_BASE, -1, _RING), n)[: n - width + 1])


def within(words: Words, width: int) -> np.ndarray:
    """Which windows of ``width`` words lie inside one text."""
    doc = words.doc
    return doc[width - 1 :] == doc[: len(doc) - width + 1] if len(doc) >= width else np.zeros(0, dtype=bool)


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``SLICE_BYTES`` of text, so that memory follows one slice."""
    length = np.nan_to_num(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
    group = (np.cumsum(length) // SLICE_BYTES).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def by_slice(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, text: str = "text") -> DataFrame:
    """Apply ``work`` to slices of Arrow batches of ``df``, in the tasks that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return df.mapInArrow(run, schema)
