"""Feed-page extraction for JSON pages (FEED3-FEED5, FEED7).

Each page document is parsed once (VARIANT for status pages, where a JSON
null and a missing key mean different things; a fixed StructType for action
pages), exploded with its position, and projected. All built-in
expressions: the work stays in whole-stage codegen.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..functions import dates


def _vget(v: Column, path: str, typ: str) -> Column:
    return F.try_variant_get(v, F.lit(path), typ)


def status_items(pages: DataFrame, keep: list[str]) -> DataFrame:
    """FEED3 / FEED7: one row per status with its array position. Adds
    ``is_original``: true iff ``retweeted_status`` is present and JSON null
    (FEED3a; a missing key counts as not original)."""
    v = F.try_parse_json("doc")
    ex = pages.select(*keep, F.posexplode(_vget(v, "$.statuses", "array<variant>")).alias("pos", "s"))
    s = F.col("s")
    rt = _vget(s, "$.retweeted_status", "variant")
    return ex.select(
        *keep, "pos",
        _vget(s, "$.id", "bigint").alias("id"),
        _vget(s, "$.user_id", "bigint").cast("string").alias("user_id"),
        _vget(s, "$.title", "string").alias("title"),
        _vget(s, "$.description", "string").alias("description"),
        _vget(s, "$.target", "string").alias("target"),
        _vget(s, "$.retweet_count", "int").alias("retweet"),
        _vget(s, "$.reply_count", "int").alias("reply"),
        _vget(s, "$.created_at", "bigint").alias("created_at"),
        _vget(s, "$.user.screen_name", "string").alias("screen_name"),
        F.coalesce(F.is_variant_null(rt), F.lit(False)).alias("is_original"))


def status_rows(items: DataFrame) -> DataFrame:
    """FEED7: every status of a page: NULL title -> '', address by id, time in seconds."""
    return items.select("page_url", "id", F.coalesce("title", F.lit("")).alias("title"),
                        F.concat(F.lit(schemas.URLS[40001]["status"]), F.col("id").cast("string")).alias("url"),
                        F.floor(F.col("created_at") / 1000).cast("bigint").alias("ts_s"), "user_id", "retweet", "reply")


def short_headline(title: Column, description: Column) -> Column:
    """FEED4a: NULL title -> first 30 chars of the description; else the
    title with tags stripped."""
    return F.when(title.isNull(), F.substring(description, 1, schemas.HEADLINE_CUT)) \
        .otherwise(fn.strip_tags(title))


def title_fallback(title: Column, screen_name: Column, owner: Column, description: Column) -> Column:
    """FEED4: title; '' -> screen name + suffix; '' name -> page owner +
    suffix. NULL title (Q3) -> the short headline."""
    sfx = F.lit(schemas.TITLE_SUFFIX)
    named = F.when(F.coalesce(screen_name, F.lit("")) != "", F.concat(screen_name, sfx)) \
        .otherwise(F.concat(owner, sfx))
    return (F.when(title.isNull(), short_headline(title, description))
            .when(title == "", named).otherwise(title))


def action_items(pages: DataFrame, keep: list[str], zone: str = "Asia/Shanghai") -> DataFrame:
    """FEED5: explode ``record``; drop OtherID '0'; ts from actionDate;
    title = user + suffix; url = article base / objectID / OtherID; body cut
    at the literal ``[quote]`` (FEED5a, Q1 fixed)."""
    p = pages.select(*keep, F.from_json("doc", schemas.ACTION_PAGE).alias("p"))
    ex = p.select(*keep, F.posexplode("p.record").alias("pos", "r"))
    r = F.col("r")
    return ex.where(r["OtherID"] != "0").select(
        *keep, "pos",
        r["actionID"].alias("action_id"), r["userID"].alias("user_id"), r["userName"].alias("user_name"),
        r["actionDate"].alias("action_date"),
        F.concat(r["userName"], F.lit(schemas.ACTION_TITLE_SUFFIX)).alias("title"),
        F.concat(F.lit(schemas.URLS[40004]["article"]), r["objectID"], F.lit("/"), r["OtherID"]).alias("url"),
        fn.string_to_millis(r["actionDate"], dates.FMT_ACTION, zone).alias("ts_ms"),
        fn.literal_split_first(r["body"], "[quote]").alias("body"))
