"""Connected components over an edge table, in Spark (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import cut, discard


def _star(edges: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """Link every neighbour of a node to the node's smallest neighbour (or itself).

    Large star: neighbours greater than the node; small star: neighbours not greater.
    A node may have very many neighbours: its minimum is found in partial sums per task,
    and joined as a table of its own, so that adaptive execution can split the other side.
    Also returns that table.
    """
    both = edges if small else edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("_m", "u"))
    low = cut(low.withColumnRenamed("u", "_u"), "cc-least")
    j = both.join(low, both["u"] == low["_u"])
    if small:
        moved = j.select(F.col("v").alias("u"), F.col("_m").alias("v")).union(
            low.select(F.col("_u").alias("u"), F.col("_m").alias("v")))
    else:
        moved = j.where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.where("u <> v").distinct(), low


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (u, v long).

    Rounds end when an alternation changes nothing; each is written to the shared folder.
    An empty edge table gives an empty result. Raises if ``rounds`` do not suffice.
    """
    spark = edges.sparkSession
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .where("u <> v").distinct(), "cc")
    mark = None
    for _ in range(rounds):
        new_mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new_mark == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        mark = new_mark
        large, low1 = _star(e, small=False)
        large = cut(large, "cc-large")
        small, low2 = _star(large, small=True)
        new = cut(small, "cc")
        for old in (e, large, low1, low2):
            discard(spark, old)
        e = new
    raise RuntimeError("components: no end within the given rounds")
