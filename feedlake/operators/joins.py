"""Join helper for hot keys.

AQE splits a skewed join partition only when both join inputs are plain
shuffle stages. When one side comes straight out of an aggregation on the
join key it is already partitioned by that key, Spark reuses that
partitioning, and the hot key's rows on the other side land in one task.
Adding ``xxhash64(keys)`` as an extra join key changes the required
distribution (``spark.sql.requireAllClusterKeysForCoPartition``), so both
sides shuffle and the hot key can be split. The extra key is a function of
the real keys: results are unchanged.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    pk = F.xxhash64(*[F.col(k) for k in keys])
    j = left.withColumn("_pk", pk).join(right.withColumn("_pk", pk), [*keys, "_pk"], how)
    return j.drop("_pk")
