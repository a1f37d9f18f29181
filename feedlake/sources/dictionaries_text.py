"""Keyword dictionary for the tag facets, derived from ``benchmark`` texts:
every distinct token of 4+ letters becomes a term; its facet is fixed by its
length (stock / industry / section by length % 3) and its code is 'K', the
term's length and the term (no case mapping: engines differ on it)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.text import FACETS, TOKEN_SPLIT, token_array
from .tables import table


def keyword_dictionary(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark").select(F.explode(token_array("text")).alias("term"))
    t = b.where(F.length("term") >= 4).distinct()
    facet = F.element_at(F.array(*[F.lit(f) for f in FACETS]), (F.length("term") % 3 + 1).cast("int"))
    return t.select("term", facet.alias("facet"),
                    F.array(F.col("term"), F.concat(F.lit("K"), F.length("term").cast("string"), F.lit(":"),
                                                    F.col("term"))).alias("aliases"))


KEYWORD_SQL = f"""
  SELECT term, ['stock', 'industry', 'section'][length(term) % 3 + 1] AS facet,
         [term, 'K' || CAST(length(term) AS VARCHAR) || ':' || term] AS aliases
  FROM (SELECT DISTINCT term FROM (
          SELECT unnest(regexp_split_to_array(lower(text), '{TOKEN_SPLIT}')) AS term FROM benchmark) t
        WHERE term <> '' AND length(term) >= 4) u"""


def phrase_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Terms of two words: neighbouring tokens of the ``benchmark`` texts; the facet by
    the term's length, as above."""
    b = table(spark, d, "benchmark").select(token_array("text").alias("t")).where(F.size("t") > 1)
    pair = F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.concat_ws(" ", F.slice("t", i, 2)))
    t = b.select(F.explode(pair).alias("term")).distinct()
    facet = F.element_at(F.array(*[F.lit(f) for f in FACETS]), (F.length("term") % 3 + 1).cast("int"))
    return t.select("term", facet.alias("facet"))


PHRASE_SQL = f"""
  SELECT DISTINCT term, ['stock', 'industry', 'section'][length(term) % 3 + 1] AS facet FROM (
    SELECT t[i] || ' ' || t[i + 1] AS term FROM (
      SELECT t, unnest(range(1, len(t))) AS i FROM (
        SELECT list_filter(regexp_split_to_array(lower(text), '{TOKEN_SPLIT}'), lambda x: x <> '') AS t FROM benchmark)))"""
