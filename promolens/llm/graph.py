"""Connected components by alternating stars, without a step that holds a component whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is the component's smallest.

    Each round links every node's larger neighbours to its smallest one, and then its smaller ones,
    until every node hangs on its root. Rounds grow with the logarithm of the longest path. Every
    round is written to the checkpoint folder, so a lost executor repeats one round at most.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    links = (
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct().checkpoint()
    )
    state = _state(links)
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi")
        links = (
            moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(least.select("hi", F.col("m").alias("lo")))
            .where("hi <> lo")
            .distinct()
            .checkpoint()
        )
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("lo").alias("node")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(links: DataFrame) -> tuple:
    """A sum over the links that is the same for the same links."""
    part = F.xxhash64("hi", "lo")
    return tuple(
        links.agg(
            F.count("*"), F.sum(part.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(part, 32))
        ).first()
    )
