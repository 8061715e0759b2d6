"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchlytics.llm.common import discard, stored

#: Alternations end long before; more would mean an error.
MOST_ROUNDS = 60


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every node of ``links`` (columns u, v).

    Alternates large and small stars. A star needs only the smallest neighbour of each node, which is
    aggregated before it moves and written, as only a join that shuffles both its sides can be
    split for a node with very many neighbours. Every round is written to the shared folder. Links to oneself are
    allowed and make a node of its own; no links give no rows.
    """
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    alone = links.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    links = links.where("u > v")
    before = _state(links)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u > v").distinct(), "large-star")
        spark = large.sparkSession
        discard(spark, least)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        links = stored(small.where("u > v").distinct(), "small-star")
        discard(spark, large, least)
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    found = links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    return found.unionByName(alone.join(found, "node", "left_anti"))
