"""Secret scans: fixed patterns, and assignments whose target name says that the value is a secret.

The lexer reads what source files and configurations have in common: a target name, an operator
(``=``, ``:``, ``:=``, ``=>``), and a value made of quoted literals, bare words and names joined by
``+``. Names keep the value they were last given, so a literal that reaches a sensitive name over
other names is found where it was written.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandspark.llm import text as T

KINDS = ("assign", "access", "hex", "literal", "flow")

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # shorter runs cannot hold a longer match, so they need no match of their own
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")

OPERATOR = re.compile(r"(?<![=!<>:+\-*/%&|^~])(?::=|=>|=|:)(?![=:/~])")
TARGET = re.compile(
    r"""(?:([A-Za-z_$][\w$.\-]*)|"([^"\n]{1,128})"|'([^'\n]{1,128})')"""  # a name, or a quoted key
    r"""(?:\[["']([^"'\n]{1,128})["']\])?[\x20\t]*(?::[\x20\t]*[A-Za-z_][\w.\[\]]*[\x20\t]*)?$""",  # ["key"], a type
    re.ASCII,
)
TERM = re.compile(
    r"""[\x20\t]*(?:[A-Za-z]{0,2}(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)|([^\s"'`,;#(){}\[\]<>+]+(?!\())|\$\{(\w+)\})""",
    re.ASCII,
)
PLUS = re.compile(r"[\x20\t]*\+(?!=)")
NAME = re.compile(r"\$?[A-Za-z_][\w.]*\Z", re.ASCII)
TARGET_REACH = 400  # longest target the lexer reads back over: a name of 128, an index and a type

#: Parts of a name and how surely they mean a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.7,
    "signature": 0.5, "signing": 0.5, "private": 0.5, "access": 0.4, "client": 0.3, "session": 0.4, "cookie": 0.5,
    "encryption": 0.5, "api": 0.4, "key": 0.4, "salt": 0.6, "pin": 0.5,
}
#: Parts of a name that say that the value only describes a secret.
HARMLESS = {"id", "name", "type", "file", "path", "url", "uri", "length", "size", "field", "label", "hint", "count", "ttl", "public"}
#: What stands in for a value in examples.
PLACEHOLDERS = ("example", "changeme", "change_me", "placeholder", "your", "xxxx", "todo", "dummy", "sample", "redacted", "none", "null", "true", "false")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", re.ASCII)
EDGE = max(map(len, PLACEHOLDERS)) - 1  # what a stand-in can reach over a seam
EXACT = 1 << 53
THRESHOLD = 0.5
SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, n_flow long, "
    "kinds array<string>, starts array<int>, ends array<int>, value_starts array<int>, scores array<double>"
)


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    value_start: int
    score: float = 1.0

    @property
    def order(self) -> tuple[int, int, int]:
        return self.start, KINDS.index(self.kind), self.end


def name_score(name: str) -> float:
    """How surely a target holds a secret: the sum over the parts of its name, at most 1."""
    parts = [p.lower() for p in PARTS.findall(name)]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    joined = "".join(parts)
    return min(1.0, max(sum(SENSITIVE.get(p, 0.0) for p in set(parts)), SENSITIVE.get(joined, 0.0)))


@dataclass(frozen=True)
class Traits:
    """What the score of a string depends on. Traits of a joined string follow from those of its parts."""

    length: float
    counts: dict[str, float]
    head: str
    tail: str
    space: bool
    stand_in: bool

    @classmethod
    def of(cls, value: str) -> Traits:
        space = any(c.isspace() for c in value)
        return cls(len(value), Counter(value), value[:EDGE], value[-EDGE:], space, _stands_in(value))

    def __add__(self, other: Traits) -> Traits:
        length = self.length + other.length
        counts = dict(self.counts)
        for c, n in other.counts.items():
            counts[c] = counts.get(c, 0) + n
        if length > EXACT:  # only the shares count from here on
            counts = {c: n / length * EXACT for c, n in counts.items()}
            length = EXACT
        head = self.head if len(self.head) == EDGE else (self.head + other.head)[:EDGE]
        tail = other.tail if len(other.tail) == EDGE else (self.tail + other.tail)[-EDGE:]
        seam = _stands_in(self.tail + other.head)
        return Traits(length, counts, head, tail, self.space or other.space, self.stand_in or other.stand_in or seam)

    def score(self) -> float:
        """How much a literal looks like a secret: long, of many characters, and not an example or a sentence."""
        if self.length < 8 or self.space or self.stand_in or self.head[0] in "<{%$":
            return 0.0
        entropy = -sum(n / self.length * math.log2(n / self.length) for n in self.counts.values() if n)
        classes = len({_class(c) for c in self.counts})
        return min(1.0, entropy / 3.5 * (0.55 + 0.15 * classes))


def _stands_in(value: str) -> bool:
    low = value.lower()
    return "://" in low or any(p in low for p in PLACEHOLDERS)


def _class(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


class Value:
    """What a name holds: literals in order, or values of other names. Values are shared and never written out, so
    a constant that is joined with itself again and again stays as small as the text that says so."""

    def __init__(self, parts: list[Value | tuple[str, int, int]]) -> None:
        self.parts = parts
        self.told = False  # its literals have been reported
        self._traits: Traits | None = None

    def traits(self) -> Traits:
        todo = [self]
        while todo:  # the parts first, without recursion
            at = todo[-1]
            open_parts = [p for p in at.parts if isinstance(p, Value) and p._traits is None]
            if open_parts:
                todo += open_parts
                continue
            todo.pop()
            if at._traits is None:
                each = [p._traits if isinstance(p, Value) else Traits.of(p[0]) for p in at.parts]
                at._traits = sum(each[1:], each[0])
        return self._traits

    def literals(self) -> Iterator[tuple[str, int, int]]:
        """The literals in it that no earlier call has told, each once."""
        todo = [self]
        while todo:
            at = todo.pop()
            if at.told:
                continue
            at.told = True
            for p in at.parts:
                if isinstance(p, Value):
                    todo.append(p)
                else:
                    yield p


def base_spans(text: str) -> Iterator[Span]:
    low = text.lower()
    if any(k in low for k in ASSIGN_KEYS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                yield Span(m.start(), m.end(), "assign", m.start(2))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= 16:
                yield Span(m.start(), m.end(), "access", m.start())
    for m in HEX.finditer(text):
        yield Span(m.start(), m.end(), "hex", m.start())


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, int, int, bool]]]]:
    """Name and value of every assignment in order. A value is a list of (text, start, end, quoted)."""
    if "=" not in text and ":" not in text:
        return
    done = 0
    for op in OPERATOR.finditer(text):
        if op.start() < done:  # inside a literal that has been read
            continue
        target = TARGET.search(text, max(done, op.start() - TARGET_REACH), op.start())
        if not target:
            continue
        name = target[4] or target[1] or target[2] or target[3]
        terms, at = [], op.end()
        while term := TERM.match(text, at):
            k = next(i for i in range(1, 6) if term[i] is not None)
            value, a, b = term[k], term.start(k), term.end(k)
            if k == 4 and value[-1] in ".,;:!?" and not terms:
                value = value.rstrip(".,;:!?")
                b = a + len(value)
            if value:
                terms.append((value, a, b, k in (1, 2, 3)))
            at = term.end()
            plus = PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if terms:
            if terms[-1][3]:
                done = at
            yield name, terms


def assigned_spans(text: str) -> Iterator[Span]:
    """Literals that reach a sensitive name: directly (``literal``) or over other names (``flow``)."""
    known: dict[str, Value] = {}
    for name, terms in assignments(text):
        parts: list[Value | tuple[str, int, int]] = []
        for value, a, b, quoted in terms:
            source = known.get(value.lstrip("$")) if not quoted and NAME.match(value) else None
            parts.append((value, a, b) if source is None else source)
        whole = parts[0] if len(parts) == 1 and isinstance(parts[0], Value) else Value(parts)
        known[name] = whole
        weight = name_score(name)
        if weight == 0:
            continue
        score = weight * whole.traits().score()
        if score >= THRESHOLD:
            kind = "flow" if any(isinstance(p, Value) for p in parts) else "literal"
            for _, a, b in whole.literals():
                yield Span(a, b, kind, a, round(score, 6))


def find(text: str | None) -> list[Span]:
    """All spans of one text. What the lexer finds inside a base span is not told again.

    A literal that reaches several sensitive names is told once, with the kind and score of the first. The work
    grows with the length of the text, however often its constants are joined.
    """
    if not text:
        return []
    spans = sorted(base_spans(text), key=lambda s: s.order)
    more, reach, at = [], 0, 0  # reach: the furthest end of the base spans that start by now
    for s in sorted(assigned_spans(text), key=lambda s: s.order):
        while at < len(spans) and spans[at].start <= s.start:
            reach = max(reach, spans[at].end)
            at += 1
        if s.end > reach:
            more.append(s)
    return sorted(spans + more, key=lambda s: s.order)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its spans by start, then kind, in code points (ends exclusive).

    ``value_starts`` tells where the secret itself begins inside the span. Null and empty texts have no
    spans. Very long texts and constants that double cost no more than their length. Repeated rows are scanned each
    for itself, other columns are ignored, nothing is shuffled.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(x.as_py()) for x in batch.column("text")]
        counts = [[sum(s.kind == k for s in spans) for spans in found] for k in KINDS]
        return pa.record_batch(
            [
                batch.column("doc_id"),
                *(pa.array(c, pa.int64()) for c in counts),
                pa.array([[s.kind for s in spans] for spans in found], pa.list_(pa.string())),
                pa.array([[s.start for s in spans] for spans in found], pa.list_(pa.int32())),
                pa.array([[s.end for s in spans] for spans in found], pa.list_(pa.int32())),
                pa.array([[s.value_start for s in spans] for spans in found], pa.list_(pa.int32())),
                pa.array([[s.score for s in spans] for spans in found], pa.list_(pa.float64())),
            ],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "kinds", "starts", "ends", "value_starts", "scores"],
        )

    return T.by_slice(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), work, SCHEMA)


def blanked(text: str | None, mark: str) -> str | None:
    spans = find(text)
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted((s.value_start, s.end) for s in spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """The documents with every secret replaced by ``mark``; all rows and all columns stay."""

    fields = [f if f.name != text else StructField(text, StringType()) for f in docs.schema.fields]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text)
        clean = pa.array([blanked(x.as_py(), mark) for x in batch.column(at)], batch.schema.field(at).type)
        return batch.set_column(at, batch.schema.field(at), clean)

    return T.by_slice(docs.withColumn(text, F.col(text).cast("string")), work, StructType(fields), text)
