"""Toxicity by a logistic classifier that is counterfactually regularised.

A text is known by the shares that words and beginnings of words have among its words. In every labelled text of
the sample that names a group of people, the name is swapped for each other name of its set and for a neutral word
that counts for nothing, and the fit pays for every change of the text's logit that a swap makes. A group's name so cannot become a
sign of toxicity because abuse often mentions it.

Words and beginnings are hashed into slots. The sample's counts choose the slots that tell the classes apart; the
fit is a Newton method on the driver, over a matrix whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm import text as T
from demandspark.sources.staging import stage

#: Names of groups that may stand for one another, in lower case.
IDENTITY_SETS: tuple[tuple[str, ...], ...] = (
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    ("christian", "muslim", "jewish", "jew", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    ("black", "white", "asian", "african", "latino", "latina", "hispanic", "arab", "european", "american"),
    ("women", "men", "girls", "boys", "transgender", "females", "males"),
    ("woman", "man", "girl", "boy", "trans", "female", "male"),
    ("gay", "lesbian", "bisexual", "queer", "straight", "heterosexual", "homosexual"),
    ("gays", "lesbians", "bisexuals", "queers", "heterosexuals", "homosexuals"),
    ("immigrants", "refugees", "foreigners", "migrants", "natives"),
    ("immigrant", "refugee", "foreigner", "migrant", "native"),
    ("blind", "deaf", "disabled", "autistic", "old", "young"),
    ("muslime", "christen", "juden", "ausländer", "flüchtlinge", "frauen", "männer"),
    ("musulmans", "chrétiens", "juifs", "étrangers", "réfugiés", "femmes", "hommes"),
    ("musulmanes", "cristianos", "judíos", "extranjeros", "refugiados", "mujeres", "hombres"),
)
_NO_LETTERS = r"[^\p{L}\p{M}]+"


@dataclass(frozen=True)
class Settings:
    """``class_rows`` of each class bound the sample; ``features`` slots of at least ``min_rows`` rows are weighed.

    A slot's value grows with its share of the words up to ``full_share``. ``swap_weight`` is the price of a
    squared change of logit, summed over all swaps in the sample; ``ridge`` is the price of a squared weight.
    """

    class_rows: int = 4096
    slot_bits: int = 24
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    full_share: float = 0.025
    features: int = 1024
    min_rows: int = 5
    least_z: float = 3.0
    ridge: float = 0.1
    swap_weight: float = 10.0
    newton_steps: int = 25
    sets: tuple[tuple[str, ...], ...] = IDENTITY_SETS


@dataclass(frozen=True)
class Model:
    """Weights of the slots that count; a slot's place in ``slots``, which is sorted, is its feature."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float
    settings: Settings

    def scores(self, column: pa.Array) -> np.ndarray:
        """Chance of label 1 for each text."""
        total, doc, slot, count = word_slots(column, self.settings, self.slots)
        at = np.searchsorted(self.slots, slot)
        value = shares(count, total[doc], self.settings)
        logit = self.bias + np.bincount(doc, weights=self.weights[at] * value, minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def shares(count: np.ndarray, total: np.ndarray, settings: Settings) -> np.ndarray:
    return np.minimum(1.0, count / np.maximum(total, 1) / settings.full_share)


def word_slots(column: pa.Array, settings: Settings, only: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Number of words of each text; then text number, slot and count of its words and their beginnings.

    A word is a run of letters in lower case, so marks and digits at its ends do not hide it. Its beginnings count
    too, since a word comes in many forms. A text's slots come in order; ``only`` names the slots wanted.
    """
    column = column.cast(pa.large_string())
    letters = pa.compute.replace_substring_regex(pa.compute.utf8_lower(column), pattern=_NO_LETTERS, replacement=" ")
    words = T.words_of(letters)
    lead = np.append(np.flatnonzero((words.data & 0xC0) != 0x80), len(words.data))
    begin, doc = np.searchsorted(lead, words.start), words.doc
    length = np.searchsorted(lead, words.end) - begin
    docs, slots = [], []
    for n in (0, *settings.prefixes):
        some = np.flatnonzero(length > n)
        end = words.end[some] if n == 0 else lead[begin[some] + n]
        hashes = T.Words(words.data, words.start[some], end, words.first).hashes()
        # a word and an equal beginning of another word are different slots
        slot = (T.mix(hashes + np.uint64(n)) >> np.uint64(64 - settings.slot_bits)).astype(np.int64)
        if only is not None:
            known = _among(slot, only)
            some, slot = some[known], slot[known]
        docs.append(doc[some])
        slots.append(slot)
    both, count = np.unique((np.concatenate(docs).astype(np.int64) << settings.slot_bits) | np.concatenate(slots), return_counts=True)
    return np.diff(words.first), both >> settings.slot_bits, both & ((1 << settings.slot_bits) - 1), count


def _among(slot: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(slot), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, slot), len(wanted) - 1)] == slot


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == 0


def sample_of(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, int]]:
    """Slots of at most ``class_rows`` labelled texts of each class, and how many ids each class has in all.

    An id that has both labels is toxic. The ids of smallest hash are taken. Of texts that share an id the one of
    the least slots stands for it. Only the ids, at most twice ``class_rows``, meet the documents.
    """
    ids = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("id"), "toxic")
    ids = ids.where(~held_out(F.col("id"))).groupBy("id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    counts = {r.toxic: r.n for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id")]
    parts = [ids.where(F.col("toxic") == y).orderBy(*order).limit(settings.class_rows) for y in (0, 1)]
    keys = parts[0].unionByName(parts[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(keys), "id")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, doc, slot, count = word_slots(batch.column("text"), settings)
        cut = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
        slots, counts = (pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (slot, count))
        columns = [batch.column("id"), batch.column("toxic"), pa.array(total, pa.int64()), slots, counts]
        return pa.record_batch(columns, names=["id", "toxic", "total", "slots", "counts"])

    found = T.by_slice(rows, work, "id long, toxic int, total long, slots array<int>, counts array<int>")
    least = F.min(F.struct("total", "slots", "counts")).alias("least")
    return stage(found.groupBy("id", "toxic").agg(least).select("id", "toxic", "least.*"), "toxicity"), counts


def informative(sample: DataFrame, settings: Settings) -> np.ndarray:
    """The ``features`` slots whose share of rows differs most clearly between the classes."""
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = sample.select("toxic", F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.sum(F.col("toxic")).alias("bad"), F.count(F.lit(1)).alias("n")
    )
    bad, rows = max(1, totals.get(1, 0)), max(1, sum(totals.values()))
    good = max(1, rows - bad)
    # difference of the two shares in standard errors of the common share
    share = F.col("n") / rows
    spread = F.sqrt(share * (1 - share) * (1 / bad + 1 / good)) + 1e-12
    z = F.abs(F.col("bad") / bad - (F.col("n") - F.col("bad")) / good) / spread
    clear = slots.where(F.col("n") >= settings.min_rows).withColumn("z", z).where(F.col("z") >= settings.least_z)
    best = clear.orderBy(F.col("z").desc(), "slot").limit(settings.features).select("slot").collect()
    return np.array([r.slot for r in best], dtype=np.int64)


def counted(sample: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The sample with the wanted slots only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("slots")
            slot, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
            known = _among(slot.astype(np.int64), wanted)
            cut = pa.array(np.searchsorted(doc[known], np.arange(batch.num_rows + 1)), pa.int32())
            kept = (pa.ListArray.from_arrays(cut, pa.array(x[known])) for x in (slot, count))
            yield pa.record_batch([*(batch.column(c) for c in ("id", "toxic", "total")), *kept], schema=batch.schema)

    return sample.mapInArrow(work, sample.schema)


def swap_changes(count: np.ndarray, total: np.ndarray, slots: np.ndarray, settings: Settings) -> np.ndarray:
    """The sum over all swaps of the outer product of the change of a text's values with itself.

    A text's occurrences of one name become occurrences of another name of the set, with all their beginnings, or
    of a neutral word that has no slot.
    """
    m = len(slots)
    found = np.zeros((m, m))
    for names in settings.sets:
        own = [np.searchsorted(slots, word_slots(pa.array([name]), settings)[2]) for name in names]
        whole = [np.searchsorted(slots, word_slots(pa.array([name]), Settings(slot_bits=settings.slot_bits, prefixes=()))[2])[0] for name in names]
        for i, old in enumerate(own):
            rows = np.flatnonzero(count[:, whole[i]] > 0)
            for j, new in enumerate([*own, own[0][:0]]):
                if i == j or not len(rows):
                    continue
                at = np.unique(np.concatenate([old, new]))
                before = count[np.ix_(rows, at)].astype(np.float64)
                moved = before[:, [np.searchsorted(at, whole[i])]]
                after = before + moved * (np.isin(at, new).astype(float) - np.isin(at, old).astype(float))
                change = shares(after, total[rows, None], settings) - shares(before, total[rows, None], settings)
                found[np.ix_(at, at)] += change.T @ change
    return found


def newton(x: np.ndarray, y: np.ndarray, row_weight: np.ndarray, penalty: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias of least weighted log loss plus half ``w' penalty w``, by Newton steps that are halved
    while they do not lower the loss. A small price on the bias keeps a single class finite. The last column of
    ``x`` is one throughout."""
    m = x.shape[1]
    full = np.zeros((m, m))
    full[:-1, :-1], full[-1, -1] = penalty, 1e-3
    w = np.zeros(m)

    def logits(w: np.ndarray) -> np.ndarray:
        return (x @ w.astype(x.dtype)).astype(np.float64)

    def loss(w: np.ndarray) -> float:
        z = logits(w)
        return float(row_weight @ (np.logaddexp(0, z) - y * z) + w @ full @ w / 2)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-logits(w)))
        slope = x.T @ (row_weight * (p - y)).astype(x.dtype) + full @ w
        root = np.sqrt(row_weight * p * (1 - p)).astype(x.dtype)[:, None]
        hessian = full.copy()
        for at in range(0, len(x), 1024):
            part = x[at : at + 1024] * root[at : at + 1024]
            hessian += part.T @ part
        step, size = np.linalg.solve(hessian + 1e-9 * np.eye(m), slope), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w, before = w - size * step, now
        now = loss(w)
        if before - now <= 1e-7 * max(1.0, before):
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows that are not held out; see ``sample_of`` for the bound.

    Each row of a class weighs so much that the classes have the shares of all labelled rows. Without any labelled
    row every score is 0.5.
    """
    sample, counts = sample_of(docs, labels, settings)
    names = pa.array([name for names in settings.sets for name in names], pa.string())
    slots = np.unique(np.concatenate([word_slots(names, settings)[2], informative(sample, settings)]))
    rows = counted(sample, slots).orderBy("id").toArrow()  # at most twice `class_rows` rows with a number per feature
    y, total = (rows.column(c).to_numpy().astype(np.float64) for c in ("toxic", "total"))
    if not len(y):
        return Model(slots, np.zeros(len(slots)), 0.0, settings)
    lists = rows.column("slots").combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    count = np.zeros((len(y), len(slots)), dtype=np.float32)
    count[doc, np.searchsorted(slots, lists.flatten().to_numpy())] = rows.column("counts").combine_chunks().flatten().to_numpy()
    penalty = settings.ridge * np.eye(len(slots)) + 2 * settings.swap_weight * swap_changes(count, total, slots, settings)
    seen = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.where(y == 1, counts.get(1, 0) / seen[1], counts.get(0, 0) / seen[0])
    weight *= len(y) / weight.sum()
    values = np.ones((len(y), len(slots) + 1), dtype=np.float32)
    values[:, :-1] = shares(count, total[:, None], settings)
    weights, bias = newton(values, y, weight, penalty, settings.newton_steps)
    return Model(slots, weights, bias, settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (chance of label 1) and ``predicted`` (1 from 0.5 on), one row per input row.

    Null and empty texts get the score of a text without known words. Rows that repeat an id are rows each;
    only ``doc_id`` and ``text`` are read. Nothing is shuffled.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.scores(batch.column("text"))
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
        )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return T.by_slice(rows, work, "doc_id long, score double, predicted int")
