"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Within a source documents are ordered by key, running sums of
their sizes tell where each one lies, and the source is cut at its exact budget; a budget above the
source's size takes whole epochs first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.running import running_sum
from demandspark.llm.text import word_count
from demandspark.sources.staging import stage


@dataclass(frozen=True)
class Recipe:
    """Sources in code point order, null last, have ``weights`` in turn and share ``share`` times all words.

    No source gives more than ``most`` times its own words; ``share`` must not exceed ``most``.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    seed: int = 42


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as the sources do, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash of the id, or of the text of a row without one."""
    own = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))
    return F.md5(F.concat_ws(":", own, F.lit(str(seed))).cast("binary"))


def sized(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """The narrow table that everything is computed from: the text is read once."""
    rows = docs.select(
        F.col("doc_id"),
        source_key(F.col("source")).alias("source_key"),
        word_count(F.col("text").cast("string")).alias("size"),
        random_key(F.col("doc_id"), F.col("text"), recipe.seed).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stage(rows, "sizes")


def targets(sizes: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Per source its size, its target, whole epochs, and the words of the last, partial epoch.

    The level is found where the targets ``min(most * size, level * weight)`` add up to the share: sources
    at their limit leave, the rest share what is left, until none is above. Only three sums a round reach
    the driver; the sources stay a table.
    """
    per = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    per = running_sum(per, ["one"], [F.col("source_key")], "one", "place")
    weights = F.array(*[F.lit(w) for w in recipe.weights])
    per = per.withColumn("weight", F.get(weights, (F.col("place") % len(recipe.weights)).cast("int")))
    per = stage(per.select("source_key", "source_size", "weight"), "sources")
    limit, weight = F.col("source_size") * recipe.most, F.col("weight")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, last = 0.0, -1
    while True:
        full = F.lit(level) * weight > limit if last >= 0 else F.lit(False)
        n, taken, left = per.agg(
            F.count_if(full), F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(weight))
        ).first()
        if n == last or not left:
            break
        last, level = n, (recipe.share * total - taken) / left
    target = F.least(limit, F.lit(level) * weight)
    rows = per.select("source_key", "source_size", target.alias("target"))
    words = F.when(F.col("source_size") > 0, F.col("source_size"))  # null for a source without words
    budget = F.floor("target").cast("long")
    return rows.withColumns(
        {
            "epochs": F.coalesce(F.floor(budget / words).cast("long"), F.lit(0)),
            "rest": F.coalesce(budget % words, F.lit(0)),
        }
    )


def placed(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """Sized rows with the words before them in their source and the source's target."""
    # rows that agree in all but the last are alike; it only lets ranges part them
    order = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("row")]
    return running_sum(sizes, ["source_key"], order, "size", "before").join(per, "source_key")


def mix(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """How many words the mix takes of every document, repeats counted.

    A null text has no words and none are taken; null sources are one source. Rows that repeat a ``doc_id``
    are documents of their own with the same key and come by size, so that reruns agree however the rows are dealt; a row without an id has a key of its text.
    An empty table gives an empty result. The words taken of a source are its target, rounded down.
    """
    sizes = sized(docs, recipe)
    size, part = F.col("size"), F.col("rest") - F.col("before")
    taken = F.col("epochs") * size + F.greatest(F.lit(0), F.least(size, part))
    return placed(sizes, targets(sizes, recipe)).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The documents of the mix, each as often as it is taken; a document on the cut stays whole.

    A source's last epoch ends at a key, so a document needs only its own key and its source's end: the
    texts are not shuffled. Documents without words are not part of a mix of words.
    """
    sizes = sized(docs, recipe)
    per = targets(sizes, recipe)
    ends = placed(sizes, per).where("before < rest").groupBy("source_key").agg(F.max("key").alias("end_key"))
    cuts = stage(per.select("source_key", "epochs").join(ends, "source_key", "left"), "cuts")
    names = docs.columns
    marked = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"),
        source_key(docs["source"]).alias("source_key"),
        random_key(docs["doc_id"], docs["text"], recipe.seed).alias("key"),
        (word_count(docs["text"].cast("string")) > 0).alias("filled"),
    ).where("filled")
    times = F.col("epochs") + F.when(F.col("key") <= F.col("end_key"), 1).otherwise(0)
    chosen = marked.join(cuts, "source_key").select("row", times.cast("int").alias("times")).where("times > 0")
    return chosen.select("row", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("row.*")
