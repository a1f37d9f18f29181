"""Key-addressable layout for the raw-page table.

The reference fetches pages by key from a key-value store. On Parquet the
equivalent is a table partitioned by ``(table_name, key_bucket)`` where
``key_bucket = pmod(xxhash64(row_key), B)``: a lookup for a bounded set of
keys reads only the partitions of their buckets (partition pruning), never
the whole store. B is sized so that one partition stays around a few GB at
the target scale (e.g. 4096 buckets for ~100 TB of pages across platforms).

For batch lookups of many keys the store is a bucketed table (``write_bucketed``): the
keys are dealt to its buckets and the pages stay where they lie (``operators.lookup``).
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096
KEYS = ("table_name", "row_key")


def key_bucket(col, buckets: int = DEFAULT_BUCKETS) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def write_store(pages: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS, mode: str = "overwrite") -> None:
    """``pages(table_name, row_key, url, html)`` -> partitioned layout. One
    shuffle by the partition keys so each partition is written by one task
    (no small-file explosion)."""
    df = pages.withColumn("key_bucket", key_bucket("row_key", buckets))
    (df.repartition("table_name", "key_bucket").write.mode(mode)
     .partitionBy("table_name", "key_bucket").parquet(path))


def read_for_keys(spark: SparkSession, path: str, keys: DataFrame, key_col: str,
                  buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """The store restricted to the partitions that can hold ``keys``. What
    reaches the driver are distinct bucket numbers, at most ``buckets`` of them."""
    asked = sorted(r.b for r in keys.select(key_bucket(key_col, buckets).alias("b")).distinct().collect()
                   if r.b is not None)
    return spark.read.parquet(path).where(F.col("key_bucket").isin(asked) if asked else F.lit(False))


def fresh_name(stem: str) -> str:
    """A table name that is not in use."""
    return f"{stem}_{uuid.uuid4().hex}"


def write_bucketed(pages: DataFrame, name: str, buckets: int = DEFAULT_BUCKETS, path: str | None = None) -> DataFrame:
    """``pages(table_name, row_key, url, html)`` -> the table ``name``, its rows dealt by
    ``KEYS`` into ``buckets`` files; returns the table. The one shuffle of the html is
    this write. ``path`` puts the files elsewhere than in the warehouse."""
    w = pages.repartition(buckets, *KEYS).write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
    (w.option("path", path) if path else w).saveAsTable(name)
    return pages.sparkSession.table(name)
