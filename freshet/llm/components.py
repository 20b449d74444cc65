"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import keep

EDGES_PER_PARTITION = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    Large-star and small-star steps alternate: each node's larger neighbours,
    then its smaller ones, are linked to the smallest node next to it. Both
    are an aggregate and an equi-join; a node with very many edges is reduced
    to one minimum map-side, and adaptive execution splits its join. Every
    round's edges are written to the checkpoint folder. The rounds end when
    the edges don't change, after a number logarithmic in the nodes. Few edges are
    read in few partitions, so that a round on them does not write many small files.
    """
    current = keep(_canonical(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    before = None
    while (now := _sum_up(current)) != before:
        before = now
        if now[0] == 0:
            break
        current = current.coalesce(-(-now[0] // EDGES_PER_PARTITION))
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _canonical(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        current = keep(
            _canonical(
                small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
            )
        )
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node u to the smaller v."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _sum_up(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return (row["n"], row["x"])
