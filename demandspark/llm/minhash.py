"""MinHash near-dedup: BagMinHash signatures of shingle multisets, bands, and a check of the overlap.

A shingle with weight ``w`` owns the part from 0 to ``w`` of a weight axis. The axis is cut at 1, 2, 4, 8, ...;
each piece has its own Poisson process of points in time, seeded by the shingle, and a point has a place in the
piece, found by halving. Points beyond ``w`` do not count. Every point falls into one register, and a register
keeps its earliest point. Two texts agree in a register with a probability of just their weighted Jaccard
similarity: the points under both weights are shared, those between the weights are not.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm import text as T
from demandspark.llm.components import components
from demandspark.sources.staging import stage

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Settings:
    """With 32 bands of 4 registers a pair of similarity 0.8 shares no band with a chance of 5e-8."""

    width: int = 5
    percent: int = 80
    registers: int = 128
    band: int = 4
    fill: float = 8.0
    rarity_slots: int = 1 << 18
    hot_buckets: int = 4096
    block_rows: int = 1 << 26


def shingles(words: T.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle. A text of fewer words is one shingle of all its words."""
    h = words.hashes()
    count = np.diff(words.first)
    inside = T.within(words, width)
    found, doc = T.windows(h, width)[inside], words.doc[: max(0, len(h) - width + 1)][inside]
    for n in range(1, width):
        few = np.flatnonzero(count == n)
        if len(few):
            found = np.concatenate([found, T.mix(T.windows(h, n)[words.first[few]] + np.uint64(n))])
            doc = np.concatenate([doc, few])
    return found, doc


def multisets(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, weight."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(first)
    return d[at], h[at], np.diff(np.append(at, len(h)))


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, settings: Settings) -> np.ndarray:
    """``n`` rows of registers; each holds 32 bits that name its earliest point. A text without items keeps zeros."""
    m = settings.registers
    total = np.bincount(doc, weights=weight, minlength=n)
    levels = np.ones(len(weight), dtype=np.int64)
    heavy = weight > 1
    levels[heavy] += np.ceil(np.log2(weight[heavy])).astype(np.int64)
    owner = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)  # the piece from low to 2 * low, or from 0 to 1
    rate = np.maximum(low, 1).astype(np.float64)
    seed = T.mix(item[owner] + level.astype(np.uint64) * _LEVEL)
    of, limit = doc[owner], weight[owner]
    best, name = np.full(n * m, np.inf), np.zeros(n * m, dtype=np.uint32)
    horizon = np.where(total > 0, m * settings.fill / np.maximum(total, 1), 0.0)
    todo = np.arange(len(owner))
    while len(todo):
        run, time, point = todo, np.zeros(len(todo)), 0
        while len(run):
            point += 1
            h = T.mix(seed[run] + np.uint64(point * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[run]
            soon = time <= horizon[of[run]]
            run, time, h = run[soon], time[soon], h[soon]
            g = T.mix(h ^ _LEVEL)
            place = low[run] + ((g >> np.uint64(32)).astype(np.int64) & (np.maximum(low[run], 1) - 1))
            counts = place < limit[run]
            slot = of[run][counts] * m + (g[counts] & np.uint64(0xFFFF)).astype(np.int64) % m
            when = time[counts]
            np.minimum.at(best, slot, when)
            wins = best[slot] == when
            name[slot[wins]] = (h[counts][wins] >> np.uint64(16)).astype(np.uint32)
        empty = np.isinf(best.reshape(n, m)).any(axis=1) & (total > 0)
        horizon = np.where(empty, horizon * 2, horizon)
        todo = np.flatnonzero(empty[of])
    return name.reshape(n, m)


def band_keys(names: np.ndarray, band: int) -> np.ndarray:
    """A 64-bit key for every band of every signature."""
    n, m = names.shape
    parts = names.reshape(n, m // band, band).astype(np.uint64)
    key = np.broadcast_to(np.arange(m // band, dtype=np.uint64) * _STEP, parts.shape[:2])
    for i in range(band):
        key = T.mix(key + parts[:, :, i] + np.uint64(1))
    return key.view(np.int64)


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per document an identity of its words and the keys of its bands; both null without words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.words_of(batch.column("text"))
        n = batch.num_rows
        data, at = words.joined(np.ones(len(words.start), dtype=bool))
        ids = [hashlib.blake2b(data[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
        hashes, doc = shingles(words, settings.width)
        keys = band_keys(signatures(*multisets(hashes, doc), n, settings), settings.band)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1)))
        full = pa.array([x is not None for x in ids])
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.compute.if_else(full, rows, pa.scalar(None, rows.type))],
            names=["doc_id", "words_id", "bands"],
        )

    return T.by_slice(docs, work, "doc_id long, words_id binary, bands array<long>")


def similar(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a``, ``b`` whose multisets overlap enough: sum of lesser weights over sum of greater ones."""

    def weigh(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        doc, item, weight = multisets(*shingles(T.words_of(column), settings.width))
        cut = np.searchsorted(doc, np.arange(len(column) + 1))
        return [(item[x:y], weight[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        # rows come sorted by a, so a text that stands for many pairs is weighed once a slice
        left = batch.column("a").to_numpy()
        new = np.concatenate([[True], left[1:] != left[:-1]])
        sets = weigh(batch.column("a_text").take(pa.array(np.flatnonzero(new))))
        good = []
        for (item_b, weight_b), i in zip(weigh(batch.column("b_text")), np.cumsum(new) - 1, strict=True):
            item_a, weight_a = sets[i]
            _, x, y = np.intersect1d(item_a, item_b, assume_unique=True, return_indices=True)
            shared = int(np.minimum(weight_a[x], weight_b[y]).sum())
            union = int(weight_a.sum() + weight_b.sum()) - shared
            good.append(100 * shared >= settings.percent * union)
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    rows = pairs.join(b, "b").join(a, "a").select("a", "b", "a_text", "b_text")
    return T.by_slice(rows, work, "a long, b long", "b_text")


def tokens(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the shingles of each text; one that a text holds n times is n tokens."""
    doc, item, weight = multisets(*shingles(T.words_of(column), settings.width))
    at = np.repeat(np.arange(len(weight)), weight)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(weight) - weight, weight)
    return doc[at], T.mix(item[at] + nth.astype(np.uint64) * _STEP)


def prefixes(texts: DataFrame, settings: Settings) -> DataFrame:
    """The rarest tokens of each text with their ``place`` from 1, so many that two similar texts share one.

    Similar texts share ``percent`` of the tokens of either one, so in an order that holds for all texts their
    first common token is not among the last of either. Any order is right; here tokens go by how often their
    slot occurs, then by hash. The driver holds a number per slot, ``rarity_slots`` of them.
    """
    slots = np.uint64(settings.rarity_slots)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot, n = np.unique((tokens(batch.column("text"), settings)[1] % slots).astype(np.int64), return_counts=True)
        return pa.record_batch([pa.array(slot), pa.array(n.astype(np.int64))], names=["slot", "n"])

    counts = T.by_slice(texts, count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(settings.rarity_slots, dtype=np.int32)
    often[counts.column("slot").to_numpy()] = np.minimum(counts.column("n").to_numpy(), np.iinfo(np.int32).max)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, token = tokens(batch.column("text"), settings)
        order = np.lexsort((token, often[(token % slots).astype(np.int64)], doc))
        doc, token = doc[order], token[order]
        total = np.bincount(doc, minlength=batch.num_rows).astype(np.int64)
        place = np.arange(len(doc)) - (np.cumsum(total) - total)[doc] + 1
        keep = place <= (total - -(-settings.percent * total // 100) + 1)[doc]
        doc = doc[keep]
        return pa.record_batch(
            [batch.column("doc_id").take(pa.array(doc)), pa.array(token[keep].view(np.int64)), pa.array(place[keep]), pa.array(total[doc])],
            names=["doc_id", "token", "place", "total"],
        )

    return T.by_slice(texts, work, "doc_id long, token long, place long, total long")


def joined(rows: DataFrame, buckets: DataFrame, total: int, settings: Settings) -> DataFrame:
    """``rows`` with the columns of their bucket in ``buckets``, which has a ``crowd``; a large bucket is no hot key.

    Buckets with more than one part in ``hot_buckets`` of all ``total`` rows go to every task, fewer than
    ``hot_buckets`` of them; only the rows of the others are dealt by bucket.
    """
    large = F.col("crowd") * settings.hot_buckets > total
    few = buckets.where(large)
    often = rows.join(F.broadcast(few), "bucket")
    seldom = rows.join(F.broadcast(few.select("bucket")), "bucket", "left_anti").join(buckets.where(~large), "bucket")
    return often.unionByName(seldom)


def near_labels(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """``doc_id`` and ``label`` of every node after two hops along links to the neighbour of the most crowded buckets.

    Around an original that is linked with its copies this is the whole class already.
    """
    ends = found.join(nodes.select(F.col("doc_id").alias("a"), F.col("middle").alias("a_middle")), "a")
    ends = ends.join(nodes.select(F.col("doc_id").alias("b"), F.col("middle").alias("b_middle")), "b")
    a, b = (F.struct(F.col(f"{x}_middle").alias("middle"), (-F.col(x)).alias("id")) for x in "ab")
    both = ends.select(F.inline(F.array(F.struct(a.alias("x"), b.alias("y")), F.struct(b.alias("x"), a.alias("y")))))
    best = both.groupBy("x").agg(F.max("y").alias("y")).select((-F.col("x.id")).alias("from"), (-F.greatest("x", "y")["id"]).alias("to"))
    best = stage(best, "pointers")
    label = nodes.join(best, nodes["doc_id"] == best["from"], "left").select("doc_id", F.coalesce("to", "doc_id").alias("label"))
    label = label.join(best, label["label"] == best["from"], "left").select("doc_id", F.coalesce("to", "label").alias("label"))
    return stage(label, "classes")


def merged(label: DataFrame, found: DataFrame) -> DataFrame:
    """``label`` after the classes at both ends of each found link have become one."""
    ends = found.join(label.select(F.col("doc_id").alias("a"), F.col("label").alias("own")), "a")
    ends = ends.join(label.select(F.col("doc_id").alias("b"), F.col("label").alias("other")), "b")
    moved = components(ends.select(F.col("own").alias("a"), F.col("other").alias("b")))
    if moved is None:
        return label
    moved = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return stage(label.join(moved, "label", "left").select("doc_id", F.coalesce("to", "label").alias("label")), "classes")


def open_seats(members: DataFrame, label: DataFrame, total: int, settings: Settings) -> DataFrame:
    """``members`` with their ``label``, of the buckets of three and more that hold several classes; a bucket of two
    has been checked in full."""
    seats = members.where("crowd > 2").join(label, "doc_id")
    several = seats.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.first("crowd").alias("crowd"))
    several = stage(several.where("low <> high").select("bucket", "crowd"), "open")
    rows = joined(members.select("bucket", "doc_id"), several, total, settings)
    return stage(rows.join(label, "doc_id"), "seats")


def close(members: DataFrame, total: int, label: DataFrame, texts: DataFrame, tested: DataFrame, settings: Settings) -> DataFrame:
    """``label`` after every link between texts of a bucket is in it, by a prefix-filter join.

    Joined are the texts of buckets that hold several classes; a bucket of two has been checked in full. Of a
    token's texts those outside its largest class meet all others, so pairs inside a large class are not listed.
    Texts meet only if their numbers of tokens are near enough, and a pair counts only if the tokens from the
    shared one on can still be enough. Pairs come in blocks of some ``block_rows`` joined rows; classes that one
    block has merged are not compared by the next.
    """
    odd = stage(open_seats(members, label, total, settings).select("doc_id").distinct(), "odd")
    if not odd.count():
        return label
    rare = stage(prefixes(texts.join(odd, "doc_id"), settings), "prefixes")
    was = label.select("doc_id", F.col("label").alias("was"))
    each = rare.join(was, "doc_id").groupBy("token", "was").agg(F.count(F.lit(1)).alias("n"))
    main = each.groupBy("token").agg(
        F.max_by("was", F.struct("n", "was")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")
    )
    main = stage(main.where("classes > 1"), "tokens")
    work = main.agg(F.sum(F.expr("double(n - most) * n"))).first()[0]
    if work is None:
        return label
    # two texts of the similarity asked for have sizes in the same or in adjoining steps
    step = F.floor(F.log(F.col("total")) / F.log(F.lit(100.0 / settings.percent)) + 1e-9).cast("int")
    rare = rare.join(main.select("token", "main"), "token").withColumn("step", step).join(was, "doc_id")
    rare = stage(rare.select("doc_id", "token", "place", "total", "step", (F.col("was") != F.col("main")).alias("other")), "shared")
    blocks = max(1, ceil(work / settings.block_rows))
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for block in range(blocks):
        now = rare.join(label, "doc_id")
        x = now.where("other").where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == block)
        x = x.withColumn("step", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1))).alias("x")
        enough = (F.col("x.total") + F.col("y.total")) * settings.percent <= (
            F.least(F.expr("x.total - x.place"), F.expr("y.total - y.place")) + 1
        ) * (100 + settings.percent)
        once = F.expr("x.token = y.token and x.step = y.step and x.label <> y.label and (not y.other or x.doc_id < y.doc_id)")
        ends = x.join(now.alias("y"), once & enough)
        pairs = ends.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
        found = stage(similar(stage(pairs.join(done, ["a", "b"], "left_anti"), "pairs"), texts, settings), "found")
        label = merged(label, found)
    return label


def meetings(chosen: DataFrame, members: DataFrame, total: int, settings: Settings) -> DataFrame:
    """The pairs ``a``, ``b`` of each member and those that stand for its bucket, once each; with a ``label`` of both
    only those of different classes."""
    by_class = "label" in members.columns
    met = joined(members.withColumnRenamed("doc_id", "b").select("bucket", "b", *["label"] * by_class), stage(chosen, "chosen"), total, settings)
    if by_class:
        met = met.select(F.explode("stand").alias("x"), "b", "label").where(F.col("x.label") != F.col("label")).select(F.col("x.doc_id").alias("a"), "b")
    else:
        met = met.select(F.explode("stand").alias("a"), "b").where("a <> b")
    once = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) if by_class else met
    return stage(once.distinct(), "pairs")


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id`` and ``class_id``, the smallest ``doc_id`` that similar texts lead to; one row per input row.

    Texts of equal words are one text from the start. Texts that share a band are a bucket. A bucket's pairs are
    never listed: its members are checked against a few of them that stand for it. This is the member whose
    buckets are the most crowded, which is the original of a group of edited copies or close to it; a bucket of two
    is checked in full by that. Only members of buckets that hold several classes after that meet two more, picked by
    hashes of text and bucket, and only those of another class. ``close`` then finds what links are left
    between texts of a bucket that are in different classes.

    Null and empty texts have no shingles and are classes of their own, as are rows with a null ``doc_id`` (null
    class). Rows that share a ``doc_id`` are one document. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = stage(sketches(rows, settings), "sketches")
    filled = known.where("words_id is not null and doc_id is not null")
    first = filled.groupBy("words_id").agg(F.min("doc_id").alias("head"), F.min_by("bands", "doc_id").alias("bands"))
    heads = stage(first, "heads")
    banded = heads.select(F.col("head").alias("doc_id"), F.explode("bands").alias("bucket"))
    shared = stage(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"), "buckets")
    total = shared.agg(F.coalesce(F.sum("crowd"), F.lit(0))).first()[0]
    members = stage(joined(banded, shared, total, settings), "members")
    nodes = stage(members.groupBy("doc_id").agg(F.sum("crowd").alias("middle")), "nodes")
    texts = stage(rows.join(nodes.select("doc_id"), "doc_id"), "texts")

    seats = members.join(nodes, "doc_id")
    first = F.max(F.struct("middle", (-F.col("doc_id")).alias("order"), "doc_id"))["doc_id"]
    pairs = meetings(seats.groupBy("bucket").agg(F.first("crowd").alias("crowd"), F.array(first).alias("stand")), members, total, settings)
    found = stage(similar(pairs, texts, settings), "found")
    label = merged(near_labels(found, nodes), found)
    # only buckets that still hold several classes need more to stand for them
    seats = open_seats(members, label, total, settings)
    if seats.count():
        more = [F.max(F.struct(F.xxhash64("doc_id", "bucket", F.lit(i)), "doc_id", "label")) for i in (1, 2)]
        more = F.transform(F.array(*more), lambda x: F.struct(x["doc_id"].alias("doc_id"), x["label"].alias("label")))
        chosen = seats.groupBy("bucket").agg(F.first("crowd").alias("crowd"), more.alias("stand"))
        met = meetings(chosen, seats.select("bucket", "doc_id", "label"), total, settings)
        done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        met = stage(met.join(done, ["a", "b"], "left_anti"), "pairs")
        label = merged(label, stage(similar(met, texts, settings), "found"))
        label = close(members, total, label, texts, pairs.unionByName(met), settings)

    least = label.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    head_class = label.join(least, "label").select(F.col("doc_id").alias("head"), "class_id")
    named = filled.select("doc_id", "words_id").join(heads.select("words_id", "head"), "words_id").join(head_class, "head", "left")
    named = named.select("doc_id", F.coalesce("class_id", "head").alias("class_id"))
    alone = known.where("words_id is null or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return named.unionByName(alone)


def without_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose id is that of their class, one row each; the columns stay.

    A row with a null ``doc_id`` is nobody's copy and stays. Of rows that share a ``doc_id`` the one of the least
    text stays (null is less than any), so that reruns keep the same one.
    """
    keep = classes(docs, settings).where("doc_id = class_id").select("doc_id").distinct()
    place = "__place"
    order = Window.partitionBy("doc_id").orderBy("text", *[f"`{c}`" for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind])
    first = docs.join(keep, "doc_id", "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return first.select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.where("doc_id is null"))
