"""Connected components of a table of links, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.sources.staging import stage


def components(links: DataFrame) -> DataFrame | None:
    """``node`` and ``label`` for every node of ``links`` (``a``, ``b``, both long, not null); None without a link
    between two nodes.

    In each round a node points to the least of itself and its neighbours in a random order and from there one
    more hop, links move to where their ends point, and links within one node vanish. The order is a hash of the
    node, so the rounds grow with the logarithm of a component, chains included. A node with very many links is
    combined in the tasks first and is a skewed key of plain joins after that. The driver sees only whether links
    are left.
    """
    both = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage(both, "links")
    labels: DataFrame | None = None
    while edges.count():  # one look at the footers
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("id"))
        least = ends.groupBy("a").agg(F.min(ranked("b")).alias("best"))
        to = least.select(F.col("a").alias("from"), F.least(ranked("a"), F.col("best"))["id"].alias("to"))
        to = stage(to, "pointers")
        on = to.select(F.col("from").alias("to"), F.col("to").alias("next"))  # a target points on, or to itself
        to = stage(to.join(on, "to").select("from", F.col("next").alias("to")), "pointers")
        if labels is None:
            labels = to.select(F.col("from").alias("node"), F.col("to").alias("label"))
        else:
            moved = labels.join(to, labels["label"] == to["from"], "left")
            labels = stage(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        for end in ("a", "b"):
            edges = edges.join(to, edges[end] == to["from"]).drop(end, "from").withColumnRenamed("to", end)
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = stage(edges, "links")
    return labels
