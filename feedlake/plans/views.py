"""Per-platform views over the unified tables.

One ``articles(platform_id, user_id, title, url, ts, summary, metrics
MAP<STRING,BIGINT>, price)`` table, partitioned by ``platform_id``; each view
selects one partition (partition pruning) and names the columns as the
per-platform tables did. Same for ``profiles``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Legacy column lists of the per-platform article tables.
ARTICLE_VIEWS = {
    40001: ["user_id", "title", "retweet", "reply", "url", "ts", "summary"],
    40002: ["user_id", "title", "recommend", "time", "reproduce", "comment", "url", "ts", "summary"],
    40003: ["user_id", "title", "read_count", "buy_count", "price", "url", "ts", "summary"],
    40004: ["user_id", "title", "recommend", "read", "comment", "url", "ts", "summary"],
    40005: ["user_id", "title", "retweet", "reply", "like_count", "url", "ts", "summary"],
}
# Legacy column lists of the per-platform VIP tables.
PROFILE_VIEWS = {
    40001: ["user_id", "followers_count", "name", "introduction", "home_page", "portrait", "official_vip"],
    40002: ["user_id", "vip", "name", "introduction", "home_page", "portrait"],
    40003: ["user_id", "followers_count", "vip", "name", "introduction", "home_page", "portrait", "field"],
    40004: ["user_id", "followers_count", "vip", "name", "introduction", "home_page", "portrait", "marrow",
            "recommend"],
    40005: ["user_id", "followers_count", "official_vip", "name", "introduction", "home_page", "portrait"],
}
_ARTICLE_BASE = {"user_id", "title", "url", "ts", "summary", "price"}


def article_view(articles: DataFrame, platform_id: int) -> DataFrame:
    """Columns outside the unified set come from the ``metrics`` map (0 when
    absent); ``time`` is kept as the formatted metric text when present."""
    cols = []
    for c in ARTICLE_VIEWS[platform_id]:
        if c in _ARTICLE_BASE and c in articles.columns:
            cols.append(F.col(c))
        elif "metrics" in articles.columns:
            cols.append(F.coalesce(F.element_at("metrics", F.lit(c)), F.lit(0)).alias(c))
        else:
            cols.append(F.lit(0).cast("bigint").alias(c))
    return articles.where(F.col("platform_id") == platform_id).select(*cols)


def profile_view(profiles: DataFrame, platform_id: int) -> DataFrame:
    cols = [F.col(c) if c in profiles.columns else F.lit(None).cast("string").alias(c)
            for c in PROFILE_VIEWS[platform_id]]
    return profiles.where(F.col("platform_id") == platform_id).select(*cols)
