"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Texts are cut where no piece can reach across, which leaves short stretches that repeat often. A Python
worker encodes a distinct stretch once, as long as it remembers it; all new ones of a slice together in numpy: the trie is walked
from every character at once, then best scores move from left to right in all stretches at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from demandspark.llm import text as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0
AT_ONCE = 20_000  # stretches whose paths are searched together
MEMO = 200_000  # distinct stretches a worker remembers; beyond it starts afresh


def rank_log_scores(n: int) -> np.ndarray:
    """Log scores for pieces that only have a rank: a Zipf law over the ranks."""
    weights = 1.0 / (np.arange(n) + 2.7)
    return np.log(weights / weights.sum())


@dataclass
class Model:
    """Pieces with log scores. ``bytes_at`` is the id of byte 0, or -1 without byte fallback."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray  # 0 ordinary, 1 byte, 2 unknown, 3 control or unused
    dummy_prefix: bool = True
    byte_ids: np.ndarray = field(init=False)
    unknown: int = field(init=False)

    def __post_init__(self) -> None:
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        for i in np.flatnonzero(self.kinds == 1):
            self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        unknown = np.flatnonzero(self.kinds == 2)
        self.unknown = int(unknown[0]) if len(unknown) else -1
        if self.unknown < 0 and (self.byte_ids < 0).any():
            raise ValueError("a model needs an unknown piece or a piece for every byte")


def load(path: str, ranked: bool = True) -> Model:
    """Pieces of a model file, read on the driver; the vocabulary is the bound of what is sent to tasks.

    ``ranked``: the file's scores are merge ranks, as in BPE files, and become ``rank_log_scores``.
    """
    with open(path, "rb") as f:
        sp = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    n = sp.get_piece_size()
    kinds = np.array([1 if sp.is_byte(i) else 2 if sp.is_unknown(i) else 3 if sp.is_control(i) or sp.is_unused(i) else 0 for i in range(n)])
    scores = np.array([sp.get_score(i) for i in range(n)], dtype=np.float64)
    if ranked:
        own = np.flatnonzero(kinds == 0)
        order = own[np.argsort(-scores[own], kind="stable")]
        scores[order] = rank_log_scores(len(order))
    return Model([sp.id_to_piece(i) for i in range(n)], scores, kinds)


class DoubleArray:
    """Double-array trie over the UTF-8 bytes of the pieces.

    Node ``s`` goes by byte ``b`` to ``base[s] + b + 1`` if ``check`` there is ``s``; ``value`` is a piece id or -1.
    """

    def __init__(self, words: dict[bytes, int]) -> None:
        size = 1 << 12
        self.base, self.check, self.value = (np.full(size, x, dtype=np.int32) for x in (0, -1, -1))
        taken = bytearray(size)
        taken[0] = 1
        tree: dict = {}
        for word, i in words.items():
            node = tree
            for b in word:
                node = node.setdefault(b, {})
            node[-1] = i
        first, todo = 1, [(0, tree)]
        while todo:
            at, node = todo.pop()
            self.value[at] = node.get(-1, -1)
            codes = sorted(b + 1 for b in node if b >= 0)
            if not codes:
                continue
            first = taken.find(0, first)
            spot = first if first >= 0 else len(taken)
            while True:
                base = spot - codes[0]
                if base + 257 >= len(taken):
                    taken.extend(bytes(len(taken)))
                    grown = len(taken)
                    self.base, self.check, self.value = (
                        np.concatenate([x, np.full(grown - len(x), fill, dtype=np.int32)])
                        for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1))
                    )
                if base >= 0 and not any(taken[base + c] for c in codes):
                    break
                spot = taken.find(0, spot + 1)
                spot = spot if spot >= 0 else len(taken) - 1
            first = max(first, 1)
            self.base[at] = base
            for c in codes:
                taken[base + c] = 1
                self.check[base + c] = at
                todo.append((base + c, node[c - 1]))


class Codec:
    def __init__(self, model: Model) -> None:
        self.model = model
        own = np.flatnonzero(model.kinds == 0)
        words: dict[bytes, int] = {}
        for i in own:
            words.setdefault(model.pieces[i].replace(MARK, " ").encode(), int(i))
        self.trie = DoubleArray(words)
        self.longest = max(map(len, words), default=0)
        self.unknown_score = (model.scores[own].min() if len(own) else 0.0) - UNKNOWN_PENALTY
        whole = re.compile(r"(?s).+")  # a run of unknown characters is one piece, wherever it goes
        own_pieces = [model.pieces[i].replace(MARK, " ") for i in own]
        self.splitter = self._splitter(own_pieces) if (model.byte_ids >= 0).all() else whole
        self.memo: dict[str, int] = {}
        self.ids, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64)
        plain = [
            b""
            if k == 3
            else bytes([int(p[3:5], 16)])
            if k == 1
            else b" \xe2\x81\x87 "
            if k == 2
            else p.replace(MARK, " ").encode()
            for p, k in zip(model.pieces, model.kinds.tolist(), strict=True)
        ]
        self.piece_bytes = np.frombuffer(b"".join(plain), dtype=np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in plain])])

    @staticmethod
    def _splitter(pieces: list[str]) -> re.Pattern:
        """Cuts before a space and around line ends, as far as no piece reaches across such a place."""
        if any(" " in p.lstrip(" ") for p in pieces):
            return re.compile(r"(?s).+")
        if any("\n" in p for p in pieces):
            return re.compile(r" +[^ ]*|[^ ]+")
        return re.compile(r" +[^ \n]*|[^ \n]+|\n+")

    def stretches(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(MARK, " ")
        return self.splitter.findall(" " + text if self.model.dummy_prefix else text)

    def viterbi(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and how many each has."""
        raw = [p.encode() for p in parts]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        n = len(data)
        part_end = np.repeat(bounds[1:], np.diff(bounds))
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        lead_end = np.append(leads[1:], n)
        starts, ends, ids = [], [], []
        state, origin = np.zeros(len(leads), dtype=np.int64), leads
        single = np.zeros(n, dtype=bool)
        char_end = np.zeros(n, dtype=np.int64)
        char_end[leads] = lead_end
        for depth in range(self.longest):
            at = origin + depth
            alive = at < part_end[origin]
            origin, state, at = origin[alive], state[alive], at[alive]
            if not len(origin):
                break
            to = self.trie.base[state] + data[at].astype(np.int64) + 1
            good = self.trie.check[to] == state
            origin, state, at = origin[good], to[good], at[good]
            value = self.trie.value[state]
            hit = value >= 0
            starts.append(origin[hit])
            ends.append(at[hit] + 1)
            ids.append(value[hit])
            single[origin[hit]] |= char_end[origin[hit]] == at[hit] + 1
        lone = leads[~single[leads]]
        starts, ends = np.concatenate([*starts, lone]), np.concatenate([*ends, char_end[lone]])
        ids = np.concatenate([*ids, np.full(len(lone), -1)]).astype(np.int32)
        gain = np.where(ids >= 0, self.model.scores[ids], self.unknown_score)
        # a place is a byte offset, plus one place per part for its end
        part = np.repeat(np.arange(len(raw)), np.diff(bounds))
        shift = part[starts] if len(starts) else starts
        near = starts - bounds[shift]
        small = len(near) == 0 or near.max() < 1 << 16
        order = np.argsort(near.astype(np.uint16) if small else near, kind="stable")
        a, b, gain, ids, near = starts[order] + shift[order], ends[order] + shift[order], gain[order], ids[order], near[order]
        best = np.full(n + len(raw), -np.inf)
        best[bounds[:-1] + np.arange(len(raw))] = 0.0
        via = np.full(n + len(raw), -1, dtype=np.int64)
        steps = np.concatenate([[0], np.flatnonzero(np.diff(near)) + 1, [len(near)]]) if len(near) else [0]
        for x, y in zip(steps[:-1], steps[1:], strict=True):
            reach = best[a[x:y]] + gain[x:y]
            to = b[x:y]
            better = reach > best[to]
            best[to[better]] = reach[better]
            via[to[better]] = np.arange(x, y)[better]
        # walk back from the ends of all parts at once
        at = bounds[1:] + np.arange(len(raw))
        first = bounds[:-1] + np.arange(len(raw))
        who = np.flatnonzero(at > first)
        at, path, owner = at[who], [], []
        while len(who):
            edge = via[at]
            path.append(edge)
            owner.append(who)
            at = a[edge]
            more = at > first[who]
            at, who = at[more], who[more]
        if not path:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64)
        step = np.repeat(np.arange(len(path)), [len(p) for p in path])
        path, owner = np.concatenate(path), np.concatenate(owner)
        order = np.lexsort((-step, owner))
        path, owner = path[order], owner[order]
        return self._spell(ids[path], a[path] - owner, b[path] - owner, owner, data, len(raw))

    def _spell(self, ids, low, high, owner, data, n_parts) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters become their bytes, or the unknown piece (one for a run of them)."""
        if (self.model.byte_ids >= 0).all():
            times = np.where(ids >= 0, 1, high - low)
            out, who = np.repeat(ids, times), np.repeat(owner, times)
            source = np.repeat(low, times) + np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times)
            blank = out < 0
            out[blank] = self.model.byte_ids[data[source[blank]]]
        else:
            out, who = np.where(ids >= 0, ids, self.model.unknown), owner
            again = np.zeros(len(ids), dtype=bool)
            again[1:] = (ids[1:] < 0) & (ids[:-1] < 0) & (owner[1:] == owner[:-1])
            out, who = out[~again], who[~again]
        return out.astype(np.int32), np.bincount(who, minlength=n_parts)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text starts; null has none."""
        parts = [self.stretches(t or "") for t in texts]
        if len(self.memo) > MEMO:
            self.memo, self.ids, self.count = {}, np.zeros(0, np.int32), np.zeros(0, np.int64)
        unseen = list(set().union(*parts).difference(self.memo))
        for low in range(0, len(unseen), AT_ONCE):  # memory follows these, not the slice
            new = unseen[low : low + AT_ONCE]
            ids, count = self.viterbi(new)
            self.memo.update(zip(new, range(len(self.count), len(self.count) + len(new)), strict=True))
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        begin = np.cumsum(self.count) - self.count
        lookup = self.memo.__getitem__
        flat = np.fromiter(map(lookup, chain.from_iterable(parts)), dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        count = self.count[flat]
        edge = np.concatenate([[0], np.cumsum(count)])
        source = np.repeat(begin[flat] - edge[:-1], count) + np.arange(edge[-1])
        return self.ids[source], edge[bounds]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of runs of ids: pieces joined, marks as spaces, bytes as UTF-8, without the dummy prefix."""
        size = self.piece_at[ids + 1] - self.piece_at[ids]
        edge = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.piece_at[ids] - edge[:-1], size) + np.arange(edge[-1])
        data = self.piece_bytes[source].tobytes()
        out = [data[a:b].decode("utf-8", "replace") for a, b in zip(edge[at[:-1]].tolist(), edge[at[1:]].tolist(), strict=True)]
        return [x[1:] if self.model.dummy_prefix and x.startswith(" ") else x for x in out]


_CODECS: dict[str, Codec] = {}


def codec_of(model: Model) -> Codec:
    """The worker's codec of a model: it outlives the task, with what it remembers."""
    key = hashlib.sha256("\0".join(model.pieces).encode() + model.scores.tobytes() + bytes([model.dummy_prefix])).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _ids_array(ids: np.ndarray, at: np.ndarray, null: np.ndarray) -> pa.Array:
    made = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
    return pa.compute.if_else(pa.array(~null), made, pa.scalar(None, made.type)) if null.any() else made


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """``ids`` per document and whether decoding them gives the text back (``exact``).

    Null gives null ids, no count and null; an empty text gives no ids. A text that holds the whitespace mark
    itself comes back with a space there, so it is not exact. Repeated rows are encoded each for itself.
    Only ``doc_id`` and ``text`` are read, nothing is shuffled.
    """
    kept: list[Codec] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(codec_of(model))
        texts = batch.column("text").to_pylist()
        ids, at = kept[0].encode(texts)
        back = kept[0].decode(ids, at)
        null = np.array([t is None for t in texts])
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(np.diff(at), pa.int64()),
                _ids_array(ids, at, null),
                pa.array([None if t is None else t == b for t, b in zip(texts, back, strict=True)], pa.bool_()),
            ],
            names=["doc_id", "n_ids", "ids", "exact"],
        )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return T.by_slice(rows, work, "doc_id long, n_ids long, ids array<int>, exact boolean")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``text`` per row of ``doc_id`` and ``ids``; null gives null, null or unknown ids are skipped."""
    kept: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(codec_of(model))
        n = len(model.pieces)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            rows = [r if r is None else [i for i in r if i is not None and 0 <= i < n] for r in rows]
            at = np.concatenate([[0], np.cumsum([len(r or ()) for r in rows])]).astype(np.int64)
            ids = np.array([i for r in rows for i in r or ()], dtype=np.int64)
            texts = [None if r is None else t for r, t in zip(rows, kept[0].decode(ids, at), strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
