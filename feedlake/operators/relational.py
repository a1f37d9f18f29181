"""Relational catalogue queries (REL1-REL12).

The reference embeds these as SQL text for MySQL and loops over the cursor
on the driver. Here each is one DataFrame expression; the per-row probes
(count = 0, NOT IN) become single set-based joins.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import splittable_join


def one_row_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """REL1 "loose GROUP BY": MySQL returns an arbitrary row per key; here the
    row with the largest ``order`` struct is chosen (stated tie-break). A
    ``max_by`` aggregation combines map-side, so a key holding a third of the
    rows is reduced in parallel before the shuffle."""
    cols = [c for c in df.columns if c != key]
    o = F.struct(*order)
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), o).alias("_r"))
    return agg.select(key, *[F.col("_r." + c).alias(c) for c in cols])


def group_max_ordered(df: DataFrame, key: str, value: str) -> DataFrame:
    """REL2: one row per key with its largest value, ordered by that value
    descending (key ascending breaks ties)."""
    return (df.groupBy(key).agg(F.max(value).alias(value))
            .orderBy(F.col(value).desc(), F.col(key).asc()))


def not_in(spark: SparkSession, outer: DataFrame, inner: DataFrame, key: str,
           inner_key: str | None = None) -> DataFrame:
    """REL3: SQL ``x NOT IN (subquery)`` with its three-valued semantics,
    planned so that it scales: Spark's null-aware anti join only becomes a
    hash join when the subquery side can be broadcast (else a nested loop),
    so the semantics are spelled out instead:

      subquery empty            -> every outer row (even NULL keys)
      subquery holds a NULL     -> no row
      otherwise                 -> non-NULL outer keys absent from the subquery

    Both tests are uncorrelated EXISTS subqueries (evaluated once); the
    membership test is an ordinary anti join that can shuffle either side.
    """
    ik = inner_key or key
    ins = inner.select(F.col(ik).alias(key))
    any_row = ins.exists()
    any_null = ins.where(F.col(key).isNull()).exists()
    keep = (~any_row) | (F.col(key).isNotNull() & ~any_null)
    return outer.where(keep).join(ins.where(F.col(key).isNotNull()), key, "left_anti")


def topk(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """REL5: ``ORDER BY .. LIMIT k`` -> TakeOrderedAndProject (per-partition
    top-k, then a k-row merge); k is the feature, not a cap."""
    return df.orderBy(*order).limit(k)


def topk_then_filter(df: DataFrame, order: list[Column], k: int, cond: Column) -> DataFrame:
    """REL6: the filter applies to the top-k rows (Catalyst never pushes a
    filter below a limit)."""
    return topk(df, order, k).where(cond)


def nonempty_of(df: DataFrame, part_col: str, parts: list, col: str) -> DataFrame:
    """REL8: ``col != ''`` (NULL excluded too) on several tables, appended: as
    they are parts of one table, that is one scan with ``part IN (...)``."""
    return df.where(F.col(part_col).isin(*parts) & (F.col(col) != ""))


def without_rows_in(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """REL9: "count(*) = 0 per row" as one anti join."""
    rk = right_key or key
    r = right.select(F.col(rk).alias(key)) if rk != key else right.select(key)
    return left.join(r, key, "left_anti")


def per_key_count(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
                  out: str = "n") -> DataFrame:
    """REL10: count per key from ``right`` (partial aggregation before the
    shuffle), attached to every ``left`` row, 0 when absent."""
    rk = right_key or key
    counts = right.groupBy(F.col(rk).alias(key)).agg(F.count(F.lit(1)).alias(out))
    return (splittable_join(left, counts, [key], "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0))))
