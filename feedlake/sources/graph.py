"""Follower graph derived from the driver tables.

nodes     supplier: user_id = s_suppkey, followers = trunc(s_acctbal)
edges     consecutive lines of one order: supplier of line n -> supplier of
          line n+1 (an equi-join on (orderkey, linenumber + 1); no pairs
          within a group), distinct, no self loops
has_page  list pages that were crawled: s_nationkey % 3 <> 1
has_info  info pages that were crawled: s_nationkey % 2 = 0
seeds     the crawled account (list page stored) with the most followers
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def nodes(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("user_id"), F.col("s_acctbal").cast("bigint").alias("followers"),
                    F.col("s_nationkey").alias("nation"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    a = li.select("l_orderkey", (F.col("l_linenumber") + 1).alias("ln"), F.col("l_suppkey").alias("src"))
    b = li.select("l_orderkey", F.col("l_linenumber").alias("ln"), F.col("l_suppkey").alias("dst"))
    return a.join(b, ["l_orderkey", "ln"]).where(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def has_page(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where(F.col("nation") % 3 != 1).select("user_id")


def has_info(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).where(F.col("nation") % 2 == 0).select("user_id")


def friend_list_pages(spark: SparkSession, d: str) -> DataFrame:
    """Landed friend lists ``user_id, xml`` of the accounts whose list was crawled:
    every seventh account has no friends, every eleventh list is cut short."""
    of = edges(spark, d).groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("f")).withColumnRenamed("src", "user_id")
    rows = has_page(spark, d).join(of, "user_id", "left")
    f = F.when((F.col("user_id") % 7 == 3) | F.col("f").isNull(), F.array().cast("array<bigint>")).otherwise(F.col("f"))
    xml = F.concat(F.lit('<root total="'), F.size(f).cast("string"), F.lit('">'), F.array_join(F.transform(
        f, lambda x: F.concat(F.lit('<keyword userID="'), x.cast("string"), F.lit('" userName="n"/>'))), ""), F.lit("</root>"))
    cut = F.substring(xml, F.lit(1), F.length(xml) - 5)
    return rows.select("user_id", F.when(F.col("user_id") % 11 == 5, cut).otherwise(xml).alias("xml"))


def seeds(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d).join(has_page(spark, d), "user_id", "left_semi")
    return n.agg(F.max_by("user_id", F.struct("followers", "user_id")).alias("user_id")) \
        .where(F.col("user_id").isNotNull())


SQL = {
    "nodes": "SELECT s_suppkey AS user_id, CAST(trunc(s_acctbal) AS BIGINT) AS followers, s_nationkey AS nation FROM supplier",
    "edges": """SELECT DISTINCT a.l_suppkey AS src, b.l_suppkey AS dst FROM lineitem a
                JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber
                WHERE a.l_suppkey <> b.l_suppkey""",
    "has_page": "SELECT user_id FROM nodes WHERE nation % 3 <> 1",
    "has_info": "SELECT user_id FROM nodes WHERE nation % 2 = 0",
    "seeds": """SELECT user_id FROM (SELECT *, row_number() OVER (ORDER BY followers DESC, user_id DESC) AS rn
                FROM nodes WHERE user_id IN (SELECT user_id FROM has_page)) t WHERE rn = 1""",
}
WITH = "WITH RECURSIVE " + ",\n".join(f"{k} AS ({v})" for k, v in SQL.items())
