"""Block-wise search: a stated set of queries against all vectors.

Candidates are dealt into blocks of about ``block`` rows by a hash, queries
likewise, and every query block meets every candidate block in one task
(a block nested loop). Only the best few of each (query, block) leave a task;
they are ranked once more over all blocks.

Candidates with equal vectors score alike, so of each group only the smallest
ids that could be among the best are kept, chosen before any shuffle.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 4096


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor empty and holds finite numbers only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """Rows ``vec_id, v`` without repeats; of equal vectors the ``most`` smallest ids."""
    order = Window.partitionBy("v").orderBy("vec_id")
    return (rows.where("vec_id is not null").withColumn("r", F.dense_rank().over(order))
            .where(F.col("r") <= most).drop("r").distinct())


def search(rows: DataFrame, every: int, k: int, within: Callable, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` (score double): the ``k`` best candidates
    of each query, that is of each row ``vec_id, v`` (vectors of doubles) whose id
    is divisible by ``every``.

    ``within(ids, vectors, query_ids, queries)`` returns (query number, candidate
    number, score) arrays for one pair of blocks: the best ``k`` of each query
    whose id is not the query's own, ties by id. Queries meet candidates of their
    own length only."""
    import pyarrow as pa

    candidates = smallest_ids(rows, k + 1)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    n = rows.count()
    nc, nq = max(1, -(-n // block)), max(1, -(-n // (every * block)))
    deal = F.xxhash64("vec_id")
    left = (candidates.withColumn("dim", F.size("v")).withColumn("cb", F.pmod(deal, F.lit(nc)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    right = (queries.withColumn("dim", F.size("v")).withColumn("qb", F.pmod(deal, F.lit(nq)).cast("int"))
             .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nc - 1).cast("long")))))

    def matrix(t: pa.Table):
        v = t.column("v").combine_chunks()
        flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        order = np.argsort(t.column("vec_id").to_numpy(), kind="stable")
        return t.column("vec_id").to_numpy()[order], flat.reshape(t.num_rows, -1)[order]

    def pair(key, c: pa.Table, q: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if c.num_rows and q.num_rows:
            (ids, vectors), (qids, qvectors) = matrix(c), matrix(q)
            qi, ci, score = within(ids, vectors, qids, qvectors)
            found = [qids[qi], ids[ci], score]
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(np.asarray(found[2], np.float64))})

    keys = ["dim", "cb", "qb"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        pair, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

