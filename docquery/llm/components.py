"""Connected components of an edge table, by alternating large and small stars; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.shared import drop, stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node (the greater ones, or the others) to the least node about it.

    The least neighbour is an aggregate that Spark combines before the exchange; the join back to it is an equi-join
    of slim rows that adaptive execution can split where one node has very many neighbours.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    down = joined.where("v < u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long): root is the least node of its component."""
    now = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, last = state, now
        now = stored(_star(_star(last, True), False), name)
        drop(last)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    out._stored_at = now._stored_at
    return out
