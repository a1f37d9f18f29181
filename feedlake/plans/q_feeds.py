"""Proof queries: feed-page extraction (FEED1-FEED11)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import extract, feeds
from ..sources import feed_pages as fp
from ..sources.tables import table
from .oracle_common import LI_HREF, LI_TEXT
from .registry import query

SFX = schemas.TITLE_SUFFIX
ASFX = schemas.ACTION_TITLE_SUFFIX
HOME1 = schemas.URLS[40001]["home_page"]
ARTICLE4 = schemas.URLS[40004]["article"]
STATUS1 = schemas.URLS[40001]["status"]
IT = f"WITH it AS ({fp.ITEMS_SQL})"
SPAGE = f"'{fp.STATUS_HOST}' || CAST(user_id AS VARCHAR) || '/' || CAST(chunk AS VARCHAR)"
APAGE = f"'{fp.ACTION_HOST}' || CAST(user_id AS VARCHAR) || '/' || CAST(chunk AS VARCHAR)"
TITLE_SQL = ("CASE WHEN k % 7 = 0 THEN NULL WHEN event_type = 'purchase' THEN '' "
             "ELSE event_type || ' <i>' || CAST(k AS VARCHAR) || '</i>' END")
DESC_SQL = ("'<p>' || event_type || ' value ' || CAST(value AS VARCHAR) || ' for user ' "
            "|| CAST(user_id AS VARCHAR) || '</p>'")
RETWEET_SQL, REPLY_SQL = "k", "CAST(event_id % 13 AS INTEGER)"
SNAME_SQL = "CASE WHEN k % 5 = 0 THEN '' ELSE 'u' || CAST(user_id AS VARCHAR) END"


def _status(spark, d):
    return feeds.status_items(fp.status_pages(spark, d), ["page_url", "owner"])


@query("feed_list_items", f"""
SELECT page_id, unnest(range(len(regexp_extract_all(html, {LI_HREF}, 1)))) AS pos,
       unnest(regexp_extract_all(html, {LI_TEXT}, 1)) AS title,
       unnest(list_transform(regexp_extract_all(html, {LI_HREF}, 1),
              lambda h: CASE WHEN h LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || h ELSE h END)) AS url
FROM pages""")
def q_feed_list_items(spark, d):
    """FEED1: list rows -> ordered items (title, absolute url)."""
    p = table(spark, d, "pages")
    ex = extract.explode_items(p, extract.list_items("html"), ["page_id", "url"])
    return ex.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("item.text").alias("title"),
                     extract.absolute("url", F.col("item.href")).alias("url"))


@query("feed_table_items", """
SELECT page_id, unnest(range(len(regexp_extract_all(html, '<p>(.*?)</p>', 1)))) AS pos,
       unnest(list_transform(regexp_extract_all(html, '<p>(.*?)</p>', 1),
              lambda x: regexp_replace(x, '<[^>]*>', '', 'g'))) AS title,
       regexp_extract(url, '/([0-9]+)', 1) AS user_id,
       0 AS read_count, 0 AS buy_count, CAST(0.0 AS DOUBLE) AS price
FROM pages""")
def q_feed_table_items(spark, d):
    """FEED2: table rows -> items; user id from the page url; read, buy and
    price default to 0."""
    p = table(spark, d, "pages")
    ex = p.select("page_id", "url", F.posexplode(extract.paragraphs("html")).alias("pos", "row"))
    return ex.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                     extract.text_of("row").alias("title"),
                     fn.numeric_id("url").alias("user_id"), F.lit(0).alias("read_count"),
                     F.lit(0).alias("buy_count"), F.lit(0.0).alias("price"))


@query("feed_json_items", IT + f"""
SELECT {SPAGE} AS page_url, CAST(pos AS INTEGER) AS pos, event_id AS id, CAST(user_id AS VARCHAR) AS user_id,
       '{HOME1}' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) AS url,
       k AS retweet, CAST(event_id % 13 AS INTEGER) AS reply, epoch_us(ts) // 1000 AS ts_ms
FROM it WHERE event_type NOT IN ('click', 'view')""")
def q_feed_json_items(spark, d):
    """FEED3: statuses JSON -> original posts with url and counters."""
    s = _status(spark, d).where("is_original")
    return s.select("page_url", F.col("pos").cast("int").alias("pos"), "id", "user_id",
                    F.concat(F.lit(HOME1), F.expr("substring(target, 2)")).alias("url"),
                    "retweet", "reply", F.col("created_at").alias("ts_ms"))


@query("feed_original_only", IT + f"""
SELECT {SPAGE} AS page_url, event_id AS id, event_type NOT IN ('click', 'view') AS is_original FROM it""")
def q_feed_original_only(spark, d):
    """FEED3a: original iff retweeted_status is present and JSON null."""
    return _status(spark, d).select("page_url", "id", "is_original")


@query("feed_title_fallback", IT + f"""
SELECT event_id AS id,
  CASE WHEN t IS NULL THEN substring(dsc, 1, 30)
       WHEN t = '' THEN CASE WHEN sn <> '' THEN sn || '{SFX}' ELSE 'owner' || CAST(user_id AS VARCHAR) || '{SFX}' END
       ELSE t END AS title
FROM (SELECT *, {TITLE_SQL} AS t, {DESC_SQL} AS dsc, {SNAME_SQL} AS sn FROM it) x""")
def q_feed_title_fallback(spark, d):
    """FEED4 (+ FEED6c shape): title fallback chain."""
    s = _status(spark, d)
    return s.select("id", feeds.title_fallback(F.col("title"), F.col("screen_name"), F.col("owner"),
                                               F.col("description")).alias("title"))


@query("feed_short_headline", IT + f"""
SELECT event_id AS id,
  CASE WHEN t IS NULL THEN substring(dsc, 1, 30) ELSE regexp_replace(t, '<[^>]*>', '', 'g') END AS headline
FROM (SELECT *, {TITLE_SQL} AS t, {DESC_SQL} AS dsc FROM it) x""")
def q_feed_short_headline(spark, d):
    """FEED4a."""
    s = _status(spark, d)
    return s.select("id", feeds.short_headline(F.col("title"), F.col("description")).alias("headline"))


@query("feed_statuses_batch", IT + f"""
SELECT event_id AS id, coalesce({TITLE_SQL}, '') AS title,
       '{STATUS1}' || CAST(event_id AS VARCHAR) AS url,
       CAST((epoch_us(ts) // 1000) // 1000 AS BIGINT) AS ts_s,
       CAST(user_id AS VARCHAR) AS user_id, {RETWEET_SQL} AS retweet, {REPLY_SQL} AS reply
FROM it""")
def q_feed_statuses_batch(spark, d):
    """FEED7: every status, NULL title -> '', url by id, ts in seconds."""
    return feeds.status_rows(_status(spark, d)).drop("page_url")


ACT_SQL = IT + f"""
SELECT {APAGE} AS page_url, CAST(pos AS INTEGER) AS pos, CAST(event_id AS VARCHAR) AS action_id,
  CAST(user_id AS VARCHAR) AS user_id, 'u' || CAST(user_id AS VARCHAR) || '{ASFX}' AS title,
  '{ARTICLE4}' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) AS url,
  epoch_ms(timezone('Asia/Shanghai', strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M'))) AS ts_ms,
  strftime(ts, '%Y-%m-%d %H:%M') AS action_date, 'u' || CAST(user_id AS VARCHAR) AS user_name,
  event_type || ' k=' || CAST(k AS VARCHAR) AS body
FROM it WHERE event_type <> 'error'"""


def _actions(spark, d):
    return feeds.action_items(fp.action_pages(spark, d), ["page_url"])


@query("feed_actions", ACT_SQL)
def q_feed_actions(spark, d):
    """FEED5 (+ FEED5b display form: date, user id, user name, body)."""
    a = _actions(spark, d)
    return a.select("page_url", F.col("pos").cast("int").alias("pos"), "action_id", "user_id", "title", "url",
                    "ts_ms", "action_date", "user_name", "body")


@query("feed_quote_cut", IT + """
SELECT CAST(event_id AS VARCHAR) AS action_id, event_type || ' k=' || CAST(k AS VARCHAR) AS body,
       k % 4 = 0 AS had_quote
FROM it WHERE event_type <> 'error'""")
def q_feed_quote_cut(spark, d):
    """FEED5a: text before the literal [quote]."""
    p = fp.action_pages(spark, d).select(F.from_json("doc", schemas.ACTION_PAGE).alias("p"))
    r = p.select(F.explode("p.record").alias("r")).where(F.col("r.OtherID") != "0")
    return r.select(F.col("r.actionID").alias("action_id"),
                    fn.literal_split_first(F.col("r.body"), "[quote]").alias("body"),
                    F.col("r.body").contains("[quote]").alias("had_quote"))


@query("src_json_page", IT + f"""
SELECT {APAGE} AS page_url, CAST(count(*) AS INTEGER) AS size, CAST(chunk AS INTEGER) AS page_no,
       CAST(count(*) FILTER (WHERE event_type <> 'error') AS INTEGER) AS kept
FROM it GROUP BY user_id, chunk""")
def q_src_json_page(spark, d):
    """SRC7: a whole page is one JSON document, parsed with a fixed schema."""
    p = fp.action_pages(spark, d).select("page_url", F.from_json("doc", schemas.ACTION_PAGE).alias("p"))
    return p.select("page_url", F.col("p.size").alias("size"), F.col("p.pageNo").alias("page_no"),
                    F.size(F.filter("p.record", lambda r: r["OtherID"] != "0")).alias("kept"))
