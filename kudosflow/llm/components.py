"""Connected components by alternating large and small stars, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component``, the smallest id that can be reached, of every linked id.

    Ids without a link to another one are not returned. Each round is written to the
    shared folder, so that a lost executor repeats one round at most.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    linked = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(linked.select(high, low).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that both sides of a join are shuffled and adaptive execution can split
        # the ids of a hub.
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("w")), "least")
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("w").alias("v"))
            .distinct()
        )
        large = stored(large, "stars")
        least = stored(large.groupBy("u").agg(F.min("v").alias("w")), "least")
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("w").alias("v"))
            .where("u <> v")
            .unionByName(least.select("u", F.col("w").alias("v")))
            .distinct()
        )
        edges = stored(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
