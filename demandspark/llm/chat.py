"""Chat formatting: a dialogue seen by each of its speakers in turn.

For every speaker the dialogue is rendered with that speaker as the assistant and the others as named
users. Masks mark what the assistant says; a model learns only from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.running import running_sum



@dataclass(frozen=True)
class Template:
    """``part_turns`` turns make a part; a longer dialogue is several rows, so no row grows with it."""

    assistant: str = "<|assistant|>\n"
    user: str = "<|user|>\n"
    system: str = "<|system|>\n"
    end: str = "<|end|>\n"
    system_role: str = "system"
    nameless: str = "unknown"
    part_turns: int = 64


def rotate(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per dialogue, speaker and part: ``text``, and ``mask`` as start:end pairs in code points.

    A mask covers what the speaker says and the end mark after it, not the header. System turns are no
    speaker's and are never masked; a dialogue of system turns alone gives no row. Turns are ordered by
    ``turn`` (null last), speaker and text; repeated turns all stay. A null speaker is ``unknown``, a null
    text is empty, null dialogue ids are one dialogue. Other columns are ignored.

    Parts are cut by running counts over ranges of (dialogue, turn), so a dialogue with a third of all
    turns is spread over many tasks; its speakers are joined to parts, not to turns.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_key"),
        F.col("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(2**63 - 1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(template.nameless)).alias("name"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(1).alias("one"),
    )
    counted = running_sum(rows, ["conv_key"], [F.col("turn"), F.col("name"), F.col("text")], "one", "place")
    part = F.floor(F.col("place") / template.part_turns).cast("int")
    turn = F.struct("place", "name", "text")
    parts = counted.groupBy("conv_key", part.alias("part")).agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    speakers = rows.where(F.col("name") != template.system_role).select("conv_key", F.col("name").alias("speaker")).distinct()
    seen = parts.join(speakers, "conv_key")

    def header(t: Column) -> Column:
        return (
            F.when(t["name"] == template.system_role, F.lit(template.system))
            .when(t["name"] == F.col("speaker"), F.lit(template.assistant))
            .otherwise(F.concat(F.lit(template.user), t["name"], F.lit(": ")))
        )

    pieces = F.transform("turns", lambda t: F.struct(header(t).alias("head"), F.concat(t["text"], F.lit(template.end)).alias("body"), (t["name"] == F.col("speaker")).alias("own")))
    seen = seen.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("masks"))

    def step(done: Column, x: Column) -> Column:
        low = done["at"] + F.length(x["head"])
        high = low + F.length(x["body"])
        span = F.when(x["own"], F.array(F.concat_ws(":", low.cast("string"), high.cast("string"))))
        return F.struct(high.alias("at"), F.concat(done["masks"], F.coalesce(span, F.array().cast("array<string>"))).alias("masks"))

    masks = F.aggregate("pieces", start, step, lambda done: F.array_join(done["masks"], ","))
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"])), "")
    return seen.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), masks.alias("mask")
    )
