"""Licence scans: key phrases, and a positional index of rare words over licence notices.

A file's rarest licence words are looked up in the postings of the notices. Each hit votes for a notice
and a relative position (word index in the file minus word index in the notice). Where the votes for one
notice and position reach a share of the notice's weight, its mandatory key phrases decide.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import text as T

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Wording of licence notices as published by their authors, and the phrases that must be there.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
        "by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    ("mit", "released under the mit license", ("the mit license",)),
    ("mit", "licensed under the mit license", ("the mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    (
        "gpl-3.0-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
        ("under the terms of the gnu general public license", "either version 3 of the license"),
    ),
    (
        "gpl-2.0-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 2 of the license or at your option "
        "any later version",
        ("under the terms of the gnu general public license", "either version 2 of the license"),
    ),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    (
        "cc-by-4.0",
        "this work is licensed under the creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
    (
        "cc-by-sa-4.0",
        "this work is licensed under the creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike 4 0 international",),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0",
        ("mozilla public license v 2 0",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
)
LICENCE_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on ASCII-lowered UTF-8: all but the named ASCII ranges
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label:string,word:int,share:double>>"
)


@dataclass(frozen=True)
class Settings:
    """For each notice a file's ``probes`` highest-IDF words of it are looked up; ``agree`` of them must stand in the
    notice's order for a place to be looked at, and ``share`` of the notice's weight must then be found there."""

    probes: int = 8
    agree: float = 0.5
    share: float = 0.6
    drift: int = 3


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(LOWER)


VOCABULARY = frozenset(w.encode() for _, body, _ in NOTICES for w in body.split())


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and in how many of them each licence word stands, over all documents.

    Every task counts its documents; the sums are as many rows as the notices have words.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[bytes, int] = defaultdict(int)
        for value in batch.column("text"):
            for word in VOCABULARY.intersection(LICENCE_WORD.findall(lowered(value.as_py()))):
                counts[word] += 1
        counts[b""] = batch.num_rows
        return pa.record_batch(
            [pa.array([w.decode() for w in counts]), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    rows = T.by_slice(docs.selectExpr("cast(text as string) text"), work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in rows.collect()}  # at most len(VOCABULARY) + 1 rows
    return found.pop("", 0), found


class Index:
    """Positions of every word in every notice, and the words' weights over all documents."""

    def __init__(self, n_docs: int, df: dict[str, int], settings: Settings) -> None:
        self.settings = settings
        # never 0: a notice that all documents carry is a notice all the same
        self.idf = {w: math.log(1 + (n_docs + 1) / (df.get(w.decode(), 0) + 1)) for w in VOCABULARY}
        self.bodies = [body.encode().split() for _, body, _ in NOTICES]
        self.postings: list[dict[bytes, list[int]]] = []
        for words in self.bodies:
            at: dict[bytes, list[int]] = defaultdict(list)
            for q, w in enumerate(words):
                at[w].append(q)
            self.postings.append(dict(at))
        self.total = [sum(self.idf[w] for w in words) for words in self.bodies]
        self.keys = [[k.encode().split() for k in keys] for _, _, keys in NOTICES]
        self.key_words = [frozenset(w for key in keys for w in key) for keys in self.keys]
        self.lengths = [len(words) for words in self.bodies]

    def match(self, words: list[bytes], present: frozenset[bytes]) -> list[tuple[str, int, float]]:
        """Notices that stand in the words: label, where, and the share of their weight found there."""
        spots: dict[bytes, list[int]] | None = None
        best: dict[tuple[str, int], float] = {}
        for t, at_of in enumerate(self.postings):
            if not self.key_words[t] <= present:  # a key phrase cannot stand here
                continue
            if spots is None:
                spots = defaultdict(list)
                for p, w in enumerate(words):
                    if w in VOCABULARY:
                        spots[w].append(p)
            for at, share in self.aligned(t, at_of, spots):
                if share >= self.settings.share and self.verify(words, t, at):
                    found = (NOTICES[t][0], max(0, at))
                    best[found] = max(round(share, 6), best.get(found, 0.0))
        return [(label, at, share) for (label, at), share in sorted(best.items(), key=lambda x: (x[0][1], x[0][0]))]

    def aligned(self, t: int, at_of: dict[bytes, list[int]], spots: dict[bytes, list[int]]) -> Iterator[tuple[int, float]]:
        """Places where the file's rarest words of the notice agree, and the share of the notice that stands there."""
        drift = self.settings.drift
        rare = sorted((w for w in at_of if w in spots), key=lambda w: (-self.idf[w], w))[: self.settings.probes]
        votes: dict[int, set[bytes]] = defaultdict(set)
        for w in rare:
            for p in spots[w]:
                for q in at_of[w]:
                    votes[p - q].add(w)
        need = self.settings.agree * len(rare)
        near = range(-drift, drift + 1)
        for at in votes:
            agreed = set().union(*(votes[at + d] for d in near if at + d in votes))
            if len(agreed) >= need:
                yield at, self.weight(t, at, spots) / self.total[t]

    def weight(self, t: int, at: int, spots: dict[bytes, list[int]]) -> float:
        """The weight of the notice's words that stand where they should, or a few words beside it."""
        drift, total = self.settings.drift, 0.0
        for q, w in enumerate(self.bodies[t]):
            places_of = spots.get(w)
            if places_of:
                k = bisect_left(places_of, at + q - drift)
                if k < len(places_of) and places_of[k] <= at + q + drift:
                    total += self.idf[w]
        return total

    def verify(self, words: list[bytes], t: int, at: int) -> bool:
        """All key phrases of the notice stand where it was found."""
        low, high = max(0, at - self.settings.drift), at + self.lengths[t] + self.settings.drift
        part = words[low:high]
        return all(places(part, key) for key in self.keys[t])


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    n = len(phrase)
    return [i for i, w in enumerate(words) if w == phrase[0] and words[i : i + n] == phrase]


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: words, places of key phrases, labels, and the best share of a notice.

    Null and empty texts have no words, no labels and score 0. ``first_word`` and ``last_word`` are null
    without a place. Repeated rows are scanned each for itself and counted each in the frequencies; other
    columns are ignored. An empty table gives an empty result. Nothing of a document is shuffled.
    """
    index = Index(*document_frequencies(docs), settings)
    phrases = [(k.encode().split(), label) for k, label in PHRASES.items()]

    def one(text: str | None) -> tuple:
        words = LICENCE_WORD.findall(lowered(text))
        if not words:
            return 0, 0, None, None, "", "", 0.0, []
        present = VOCABULARY.intersection(words)
        hits = [(p, label) for phrase, label in phrases if present.issuperset(phrase) for p in places(words, phrase)]
        matches = index.match(words, present)
        base = {label for _, label in hits}
        starts = [p for p, _ in hits]
        return (
            len(words),
            len(hits),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | {m[0] for m in matches})),
            max((m[2] for m in matches), default=0.0),
            [{"label": a, "word": b, "share": c} for a, b, c in matches],
        )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*(one(x.as_py()) for x in batch.column("text")), strict=True)
        match = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int32()), ("share", pa.float64())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), match]
        names = "doc_id n_words n_base first_word last_word base_labels labels score matches".split()
        return pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return T.by_slice(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), work, SCHEMA)
