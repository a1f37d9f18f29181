"""Connected components by alternating large-star and small-star steps.

Every step is two grouped minima and joins back; no neighbour list is ever
collected, and the joins are in the shape whose hot keys AQE can split. Each
round is checkpointed to the shared folder. Ends when the edge set no longer
changes (it is then one star per component, centred on the smallest node).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import split_join


def _minimum(pairs: DataFrame) -> DataFrame:
    return split_join(pairs, pairs.groupBy("u").agg(F.min("v").alias("m")), ["u"])


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # large star: neighbours above u go to the smallest of u and its neighbours
    large = (_minimum(both).where("v > u")
             .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
    # small star: u and its lower neighbours go to the smallest of them
    near = _minimum(large)
    return (near.select("u", F.col("m").alias("v"))
            .unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct())


def stars(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge and is not the smallest of
    its component, from ``edges(a long, b long)``. No edges give no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .distinct().checkpoint())

    def state(df):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()

    now = state(e)
    while now["n"]:
        e = _round(e).checkpoint()
        last, now = now, state(e)
        if now == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
