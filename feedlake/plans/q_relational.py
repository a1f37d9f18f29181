"""Proof queries: relational catalogue queries (REL1-REL12)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import relational as rel
from ..sources import standins
from ..sources.tables import table
from .registry import query

W_UR = standins.with_ctes("user_rows")
W_U = standins.with_ctes("users")
W_UUR = standins.with_ctes("users", "user_rows")
W_A = standins.with_ctes("articles")
K = schemas.TOPK_ARTICLES


@query("rel_vip_candidates", W_UR + """
SELECT user_id, row_id, followers_count, vip, recommend, marrow, vip_level FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
           ORDER BY followers_count DESC, vip DESC, row_id ASC) AS rn
  FROM user_rows WHERE followers_count > 500 OR vip) t WHERE rn = 1""")
def q_rel_vip_candidates(spark, d):
    """REL1: followers > 500 OR vip, one row per user (most followers, then
    vip, then lowest row id)."""
    u = standins.user_rows(spark, d).where((F.col("followers_count") > schemas.FOLLOWER_GATE_VIP)
                                           | F.col("vip"))
    return rel.one_row_per_key(u, "user_id", [F.col("followers_count"), F.col("vip"),
                                              -F.col("row_id")])


@query("rel_small_users", W_UR + """
SELECT user_id, max(followers_count) AS followers_count FROM user_rows
WHERE followers_count < 500 GROUP BY user_id""")
def q_rel_small_users(spark, d):
    """REL2: followers < 500, grouped by user, ordered by followers desc."""
    u = standins.user_rows(spark, d).where(F.col("followers_count") < schemas.FOLLOWER_GATE_VIP)
    return rel.group_max_ordered(u, "user_id", "followers_count")


@query("rel_not_in", W_UUR + """
SELECT user_id, row_id FROM user_rows
WHERE (recommend > 6 OR marrow > 0 OR vip_level > 0)
  AND user_id NOT IN (SELECT user_id FROM users WHERE vip)""")
def q_rel_not_in(spark, d):
    """REL3: OR filter + NOT IN against the VIP table."""
    t = standins.user_rows(spark, d).where(
        (F.col("recommend") > 6) | (F.col("marrow") > 0) | (F.col("vip_level") > 0))
    v = standins.users(spark, d).where("vip").select("user_id")
    return rel.not_in(spark, t, v, "user_id").select("user_id", "row_id")


@query("rel_not_in_nulls", W_UUR + """
SELECT user_id, row_id FROM user_rows
WHERE user_id NOT IN (SELECT CASE WHEN vip THEN user_id END FROM users)""")
def q_rel_not_in_nulls(spark, d):
    """REL3 three-valued logic: a NULL in the subquery empties the result."""
    t = standins.user_rows(spark, d)
    v = standins.users(spark, d).select(F.when(F.col("vip"), F.col("user_id")).alias("user_id"))
    return rel.not_in(spark, t, v, "user_id").select("user_id", "row_id")


@query("rel_distinct_users", W_UR + "\nSELECT DISTINCT user_id FROM user_rows WHERE vip")
def q_rel_distinct_users(spark, d):
    """REL4."""
    return standins.user_rows(spark, d).where("vip").select("user_id").distinct()


@query("rel_topk", W_A + f"""
SELECT * FROM articles ORDER BY ts DESC, url LIMIT {K}""")
def q_rel_topk(spark, d):
    """REL5: newest 3000 articles."""
    return rel.topk(standins.articles(spark, d), [F.col("ts").desc(), F.col("url")], K)


@query("rel_topk_then_filter", W_A + f"""
SELECT * FROM (SELECT * FROM articles WHERE platform_id = 40005 ORDER BY ts DESC, url LIMIT {K}) a
WHERE a.summary IS NULL""")
def q_rel_topk_then_filter(spark, d):
    """REL6: top-3000 of one platform, then summary IS NULL."""
    a = standins.articles(spark, d).where(F.col("platform_id") == 40005)
    return rel.topk_then_filter(a, [F.col("ts").desc(), F.col("url")], K, F.col("summary").isNull())


@query("rel_topk_binding", W_A + "\nSELECT url, ts FROM articles ORDER BY ts DESC, url LIMIT 100")
def q_rel_topk_binding(spark, d):
    """REL5 with a limit that cuts at every scale."""
    return rel.topk(standins.articles(spark, d), [F.col("ts").desc(), F.col("url")], 100).select("url", "ts")


@query("rel_topk_then_filter_binding", W_A + """
SELECT url FROM (SELECT * FROM articles ORDER BY ts DESC, url LIMIT 90) a WHERE a.summary IS NULL""")
def q_rel_topk_then_filter_binding(spark, d):
    """REL6 with a limit that cuts: the filter sees the top rows only."""
    return rel.topk_then_filter(standins.articles(spark, d), [F.col("ts").desc(), F.col("url")], 90,
                                F.col("summary").isNull()).select("url")


@query("rel_is_null", W_A + "\nSELECT url FROM articles WHERE summary IS NULL")
def q_rel_is_null(spark, d):
    """REL7."""
    return standins.articles(spark, d).where(F.col("summary").isNull()).select("url")


@query("rel_nonempty_union", W_A + """
SELECT platform_id, url FROM articles WHERE platform_id = 40002 AND summary != ''
UNION ALL SELECT platform_id, url FROM articles WHERE platform_id = 40003 AND summary != ''
UNION ALL SELECT platform_id, url FROM articles WHERE platform_id = 40001 AND summary != ''
UNION ALL SELECT platform_id, url FROM articles WHERE platform_id = 40004 AND summary != ''""")
def q_rel_nonempty_union(spark, d):
    """REL8: four platforms' rows with a non-empty summary, in one scan."""
    return (rel.nonempty_of(standins.articles(spark, d), "platform_id", [40002, 40003, 40001, 40004], "summary")
            .select("platform_id", "url"))


def _urgent(spark, d):
    """Article rows per user stand-in: urgent orders."""
    return table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")


@query("rel_count_zero", W_U + """
SELECT user_id FROM users u WHERE NOT EXISTS
  (SELECT 1 FROM orders o WHERE o.o_custkey = u.user_id AND o.o_orderpriority = '1-URGENT')""")
def q_rel_count_zero(spark, d):
    """REL9: users with no article rows (N+1 count probes -> one anti join)."""
    return rel.without_rows_in(standins.users(spark, d).select("user_id"), _urgent(spark, d),
                               "user_id", "o_custkey")


@query("rel_article_counts", W_U + """
SELECT u.user_id, coalesce(c.n, 0) AS n_articles FROM users u
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
           GROUP BY o_custkey) c ON c.o_custkey = u.user_id""")
def q_rel_article_counts(spark, d):
    """REL10."""
    return rel.per_key_count(standins.users(spark, d).select("user_id"), _urgent(spark, d),
                             "user_id", "o_custkey", out="n_articles")


@query("rel_scan", W_U + "\nSELECT user_id, name, home_page FROM users WHERE vip")
def q_rel_scan(spark, d):
    """REL11: narrow scans (only the named columns reach the reader)."""
    return standins.users(spark, d).where("vip").select("user_id", "name", "home_page")
