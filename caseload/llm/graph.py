"""Connected components of a distributed edge list (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import stash


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """v, root (the least id of the component) of every id in ``edges`` (u, v) that is not its own root.

    Every step reduces a vertex's edges by partial aggregates, so a vertex with very many edges is no
    single task's load; each round is written to the shared folder, and the loop ends when a round
    changes nothing."""
    now = stash(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), name)
    mark = None
    while True:
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if was == mark or mark[0] == 0:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
        large = _large_star(now).where(F.col("u") != F.col("v")).distinct()
        now = stash(_small_star(large).where(F.col("u") != F.col("v")).distinct(), name)
