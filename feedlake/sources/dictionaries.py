"""Dictionaries derived from the driver tables.

name -> aliases (FN9): nation and region names, aliases = [name, code].
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

SQL: dict[str, str] = {}


def stock_dictionary(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(
        F.col("n_name").alias("name"),
        F.array(F.col("n_name"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")))
        .alias("aliases"))
    r = table(spark, d, "region").select(
        F.col("r_name").alias("name"),
        F.array(F.col("r_name"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")))
        .alias("aliases"))
    return n.unionByName(r)


SQL["stock_dictionary"] = """
  SELECT n_name AS name, [n_name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')] AS aliases FROM nation
  UNION ALL
  SELECT r_name AS name, [r_name, 'R' || CAST(r_regionkey AS VARCHAR)] AS aliases FROM region"""
