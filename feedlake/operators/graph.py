"""Follower-graph expansion (GRF1-GRF3) as breadth-first DataFrame rounds.

The reference recurses depth-first on one thread with a JVM-local visited
set. Each round here is: frontier x edges (join on user id) -> gate ->
left_anti visited -> append. The visited set and frontier are checkpointed
to the shared checkpoint folder each round (reliable checkpoint: lineage is
cut and survives executor loss). The driver loop runs once per hop; its only
action per round is an emptiness test.

Result sets equal the depth-first ones (gates and the visited test are
order-independent); every node is saved once at its smallest hop, where the
reference could save a missing page once per parent.
"""
from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import splittable_join


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def friends_of(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """``user_id`` of all friends of the frontier, with repeats; the edges of a
    hot account can be split over tasks."""
    return (splittable_join(edges.withColumnRenamed("src", "user_id"), frontier, ["user_id"])
            .select(F.col("dst").alias("user_id")))


def expand(seeds: DataFrame, edges: DataFrame, nodes: DataFrame, has_page: DataFrame,
           save_gate=None, expand_gate=None, max_rounds: int | None = None) -> DataFrame:
    """Breadth-first expansion.

    seeds(user_id)                start nodes (hop 0, never gated)
    edges(src, dst)               friend lists
    nodes(user_id, followers)     attributes of every node
    has_page(user_id)             nodes whose list page is stored (hit)
    save_gate(Column)             which friends are saved (None = all), on
                                  the friend's ``followers``
    expand_gate(Column)           which saved nodes with a page are expanded
    max_rounds                    fail beyond so many rounds (None: run until
                                  no new node is found; never a silent stop)
    Returns visited(user_id, hop, followers, has_page).

    The gated edge list is materialised once. It is deliberately *not*
    partitioned by ``src``: one account may own a third of all edges, and a
    pre-partitioned side can neither be rebalanced nor skew-split. Each round
    AQE broadcasts the frontier when its measured size is small (the usual
    case: the frontier is tiny next to the edges) and otherwise plans a
    shuffle join whose hot partitions it can split: the frontier comes out of
    joins on ``user_id``, so that takes the extra key of ``splittable_join``
    (else both sides would keep that partitioning). Each round checkpoints
    only its new nodes; the visited set is the union of the rounds, never
    rewritten.
    """
    pages = has_page.select("user_id").distinct()
    attrs = nodes.select("user_id", "followers")
    cand = edges.select("src", "dst").join(attrs.withColumnRenamed("user_id", "dst"), "dst")
    if save_gate is not None:
        cand = cand.where(save_gate)
    cand = _cut(cand.select("src", "dst").distinct())
    parts = [_cut(seeds.select("user_id").distinct().withColumn("hop", F.lit(0)))]

    def visited_ids():
        out = parts[0].select("user_id")
        for p in parts[1:]:
            out = out.unionByName(p.select("user_id"))
        return out

    frontier = parts[0].join(pages, "user_id", "left_semi").select("user_id")
    for r in count(1):
        friends = friends_of(frontier, cand).distinct()
        new = _cut(friends.join(visited_ids(), "user_id", "left_anti").withColumn("hop", F.lit(r)))
        if new.isEmpty():
            break
        if max_rounds is not None and r > max_rounds:
            raise ValueError(f"nodes beyond {max_rounds} rounds")
        parts.append(new)
        nxt = new.join(pages, "user_id", "left_semi")
        if expand_gate is not None:
            nxt = nxt.join(attrs, "user_id").where(expand_gate)
        frontier = nxt.select("user_id")
    visited = parts[0]
    for p in parts[1:]:
        visited = visited.unionByName(p)
    return (visited.join(attrs, "user_id", "left")
            .join(pages.withColumn("has_page", F.lit(True)), "user_id", "left")
            .select("user_id", "hop", "followers",
                    F.coalesce("has_page", F.lit(False)).alias("has_page")))
