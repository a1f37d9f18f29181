"""Helpers shared by the training-data operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    the lineage ends there, a lost executor costs a reread, and the shuffle files
    of the write go when it ends, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of one Arrow batch between Spark and Python.
BATCH_BYTES = "4m"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows go to Python in batches of bounded bytes instead of
    bounded rows: what a task holds then does not depend on the length of texts.
    A size the deployment has set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, None) is None:
        df.sparkSession.conf.set(key, BATCH_BYTES)
    return df


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in the shape whose hot keys AQE can split (see ``operators.joins``):
    an extra key that follows from the others makes both sides plain exchanges.
    One bit of a hash is enough for that and costs next to nothing shuffled."""
    bit = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(2)).cast("byte")
    return left.withColumn("__bit", bit).join(right.withColumn("__bit", bit), [*keys, "__bit"], how).drop("__bit")


def packed(df: DataFrame, name: str = "__row") -> DataFrame:
    """All columns of ``df`` as one struct, so that no helper column of an
    operator can clash with a column of the caller."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
