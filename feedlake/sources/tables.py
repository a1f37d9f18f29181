"""Readers for the shared Parquet tables and the other inputs the jobs take
(message files, seed url lists, JDBC tables)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filters reach the Parquet scan
    because callers select before acting."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def seed_lines(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """SRC6: one url per line. REL12: repeated lines are processed once."""
    df = spark.read.text(path).withColumnRenamed("value", "url")
    df = df.where("length(trim(url)) > 0").selectExpr("trim(url) AS url")
    return df.distinct() if distinct else df


def jdbc_table(spark: SparkSession, url: str, table_name: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
               properties: dict | None = None) -> DataFrame:
    """SRC5: relational scan over JDBC, split on a numeric key so that the
    read is parallel rather than one cursor on one task."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table_name, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table_name, properties=props)


def record_order(timestamp: str, partition: str, offset: str) -> Column:
    """A number that orders records by time, then partition, then offset."""
    digits = F.concat(F.unix_millis(timestamp).cast("string"), F.lpad(F.col(partition).cast("string"), 5, "0"),
                      F.lpad(F.col(offset).cast("string"), 19, "0"))
    return digits.cast("decimal(38,0)")


MESSAGE_FILE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def message_stream(spark: SparkSession, fmt: str = "kafka", **options) -> DataFrame:
    """SRC1: the inbound notice stream as a ``value STRING`` streaming
    DataFrame (Kafka adds ``msg_seq``, which grows with record time). With ``fmt='kafka'`` the options are the usual
    ``kafka.bootstrap.servers`` / ``subscribe``; any file format (json, text,
    parquet) with a ``path`` option gives the same shape for tests."""
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        # offsets order one topic partition only: notices are ordered by record
        # time, then by partition and offset, which one decimal of 13 + 5 + 19 digits holds
        return r.options(**options).load().select(F.col("value").cast("string").alias("value"),
                                                  record_order("timestamp", "partition", "offset").alias("msg_seq"))
    path = options.pop("path")
    if fmt != "text":
        r = r.schema(options.pop("schema", MESSAGE_FILE_SCHEMA))
    return r.options(**options).load(path).select("value")

