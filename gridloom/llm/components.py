"""Connected components by alternating star contractions (Kiveris et al., "Connected Components in MapReduce and Beyond").

Every round is two aggregations and two joins on the edge list; the edges of every round are written to the shared folder,
so neither lineage nor any state grows with the rounds, and nothing but a count comes to the driver. A node with very many
neighbours is looked up by broadcast, so its edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import lookup, scratch_scope, written

#: Rounds are logarithmic in the number of nodes in practice; far beyond that something is wrong.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    found = lookup(both.where("v > u"), least, ["u"], rows="n", total=2 * n, spread=["v"], stored=False)
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Edges point down (u > v); every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = lookup(edges, least, ["u"], rows="n", total=2 * n, spread=["v"], stored=False).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node but the roots has one edge, and that to a root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` to ``(node, root)``, root the smallest node of the component; nodes that are roots
    themselves or have no edge are left out. Self-links, repeated and reversed edges do no harm."""
    with scratch_scope(edges.sparkSession) as keep:
        now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc-0")
        for i in range(1, MAX_ROUNDS + 1):
            if _is_done(now):
                return keep(now.select(F.col("u").alias("node"), F.col("v").alias("root")), "cc")
            n = now.count()
            now = written(_small_star(_large_star(now, n), n), f"cc-{i}")
    raise RuntimeError(f"no fixed point in {MAX_ROUNDS} rounds")
