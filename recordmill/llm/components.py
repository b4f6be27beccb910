"""Connected components by alternating stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import at_most_partitions, files_for
from recordmill.session import cut_lineage

MAX_ROUNDS = 60
FEW_EDGES = 1_000_000
EDGES_A_TASK = 20_000  # at least, when there are fewer than this times the partitions


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) edges; the component is its smallest node.

    Each round ties larger neighbours to the smallest one, then smaller ones likewise, until
    nothing changes; the number of rounds grows with the logarithm of the longest path.
    Loops and repeated edges are harmless; rows with a null end are left out.
    """
    a, b = edges.columns
    line = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    stars, seen = cut_lineage(line), None
    rows = stars.count()
    if not rows:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    parts, files = at_most_partitions(edges.sparkSession, rows, EDGES_A_TASK), files_for(rows)

    def dealt(line: DataFrame) -> DataFrame:
        """One exchange in few partitions for few edges; many are left to partial sums and skew joins."""
        return line.repartition(parts, "u") if rows <= FEW_EDGES else line

    for _ in range(MAX_ROUNDS):
        both = dealt(stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = dealt(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(dealt(moved.unionByName(smallest.select("u", F.col("m").alias("v")))).distinct(), files)
        told = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if told == seen:
            break
        seen = told
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
