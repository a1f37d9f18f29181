"""Message parse / reject / route / task projection (MSG1-MSG10)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

REASON_EMPTY = "empty"
REASON_NOT_JSON = "not_json"
REASON_MISSING_KEY = "missing_key"
REASON_BAD_PLATFORM = "bad_platform_id"
REASON_UNKNOWN_PLATFORM = "unknown_platform"
REASON_PAGE_MISS = "page_miss"


def nonempty(raw: DataFrame, col: str = "value") -> DataFrame:
    """MSG1: drop NULL / empty values."""
    return raw.where(F.length(col) > 0)


def classify(raw: DataFrame, col: str = "value") -> DataFrame:
    """MSG2: parse every notice once; add ``attr_id, key_name, pos_name,
    platform_id`` and a ``reason`` that is NULL for good messages."""
    v = F.try_parse_json(F.col(col))

    parsed = raw.select("*", v.alias("_v"))
    parsed = parsed.select(
        *raw.columns,
        F.try_variant_get("_v", F.lit("$.attr_id"), "string").alias("attr_id"),
        F.try_variant_get("_v", F.lit("$.key_name"), "string").alias("key_name"),
        F.try_variant_get("_v", F.lit("$.pos_name"), "string").alias("pos_name"),
        F.col("_v").isNull().alias("_bad_json"))
    pid = F.col("attr_id").try_cast("int")
    reason = (F.when(F.col(col).isNull() | (F.length(col) == 0), F.lit(REASON_EMPTY))
              .when(F.col("_bad_json"), F.lit(REASON_NOT_JSON))
              .when(F.col("attr_id").isNull() | F.col("key_name").isNull()
                    | F.col("pos_name").isNull(), F.lit(REASON_MISSING_KEY))
              .when(pid.isNull(), F.lit(REASON_BAD_PLATFORM)))
    return parsed.select(*raw.columns, "attr_id", "key_name", "pos_name",
                         pid.alias("platform_id"), reason.alias("reason"))


def parse(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """MSG2: ``(good, rejects)``. Rejects keep the raw value and a reason."""
    c = classify(raw, col)
    good = c.where(F.col("reason").isNull()).drop("reason")
    rejects = c.where(F.col("reason").isNotNull())
    return good, rejects


def route(good: DataFrame, platforms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MSG3: attach the platform row (5-row dimension, broadcast); unmatched
    ids become rejects with reason ``unknown_platform``."""
    j = good.join(F.broadcast(platforms), "platform_id", "left")
    routed = j.where(F.col("platform_name").isNotNull())
    unknown = (j.where(F.col("platform_name").isNull())
               .select(*good.columns, F.lit(REASON_UNKNOWN_PLATFORM).alias("reason")))
    return routed, unknown


def article_task(platform_id, url, islogin) -> Column:
    """MSG5: article task JSON without the clock id (added at the sink)."""
    return F.to_json(F.struct(
        _c(islogin).cast("int").alias("islogin"),
        _c(platform_id).cast("int").alias("attrid"),
        F.lit(schemas.TASK_DEPTH).alias("depth"),
        F.lit(schemas.TASK_CUR_DEPTH).alias("cur_depth"),
        F.lit(schemas.TASK_METHOD).alias("method"),
        _c(url).alias("url")))


def crawl_task(platform_id, url, result) -> Column:
    """MSG6: crawl task JSON without the clock timestamp. Built with
    ``to_json`` so urls are escaped (the reference formatted raw strings)."""
    return F.to_json(F.struct(
        F.lit("").alias("id"),
        _c(platform_id).cast("string").alias("attrid"),
        F.lit("").alias("cookie"),
        F.lit("").alias("referer"),
        _c(url).alias("url"),
        (_c(result) if not isinstance(result, int) else F.lit(result)).cast("string").alias("result")))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def build_url(prefix: str, col, suffix: str = "") -> Column:
    """MSG8: task url = prefix + id (+ suffix)."""
    parts = [F.lit(prefix), _c(col).cast("string")]
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat(*parts)


def fanout(df: DataFrame, urls: dict[str, Column], kind_col: str = "kind",
           url_col: str = "url") -> DataFrame:
    """MSG9: one row per (input row, url kind) via explode of an array of
    structs; no join, no shuffle."""
    arr = F.array(*[F.struct(F.lit(k).alias(kind_col), u.alias(url_col)) for k, u in urls.items()])
    return df.select("*", F.inline(arr))


def list_page_requests(spark: SparkSession, pages: int = schemas.LIST_PAGES_40003) -> DataFrame:
    """MSG10: ``page_no, url`` of the list pages 1..``pages`` of platform 40003."""
    url = F.concat(F.lit(schemas.URLS[40003]["list_page"]), F.col("page_no").cast("string"))
    return spark.range(1, pages + 1).toDF("page_no").select("page_no", url.alias("url"))


def list_page_tasks(spark: SparkSession, pages: int = schemas.LIST_PAGES_40003) -> DataFrame:
    """MSG10: crawl tasks for the list pages."""
    return list_page_requests(spark, pages).select("page_no", crawl_task(F.lit(40003), "url", schemas.RESULT_CRAWL).alias("task"))


def page_range(df: DataFrame, lo, hi, col: str = "page_no") -> DataFrame:
    """MSG10: explode ``lo..hi``; empty when ``hi < lo`` (``sequence``
    would count down)."""
    lo, hi = _c(lo), _c(hi)
    seq = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(seq).alias(col))
