"""Proof queries: card feeds and list-page variants (FEED6, FEED6a, FEED6b,
FEED8, FEED10, FEED11, GRF5)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import ntz_to_millis
from ..operators import extract, increments as inc, lookup, messages
from ..sources import standins
from ..sources.tables import table
from .oracle_common import LI_HREF, LI_TEXT, crawl_task_sql
from ..operators.platform_pages import counter
from .registry import query

# Counter labels on card footers and the shifted-cell marker.
LABEL_FORWARD, LABEL_COMMENT, LABEL_LIKE = schemas.LABEL_FORWARD, schemas.LABEL_COMMENT, schemas.LABEL_LIKE
SHIFT_MARK, PERMALINK_MARK = schemas.SHIFT_MARK, schemas.PERMALINK_MARK


@query("feed_two_lists_concat", f"""
WITH c AS (SELECT page_id,
  list_concat(list_transform(regexp_extract_all(html, {LI_TEXT}, 1), lambda t: 'cover:' || t),
              list_transform(list_filter(regexp_extract_all(html, '<p>(.*?)</p>', 1), lambda p: NOT contains(p, '<b>')),
                             lambda p: 'card:' || regexp_replace(p, '<[^>]*>', '', 'g'))) AS cards
  FROM pages)
SELECT page_id, unnest(range(len(cards))) AS pos, unnest(cards) AS card FROM c""")
def q_feed_two_lists_concat(spark, d):
    """FEED6 / FEED6d: cover cards first, then normal cards, skipping cards
    with an expand block (here: a bold lead); one position sequence."""
    p = table(spark, d, "pages")
    covers = F.transform(F.regexp_extract_all("html", F.lit(extract.LI_TEXT), 1),
                         lambda t: F.concat(F.lit("cover:"), t))
    normal = F.transform(F.filter(extract.paragraphs("html"), lambda x: ~x.contains("<b>")),
                         lambda x: F.concat(F.lit("card:"), extract.text_of(x)))
    ex = p.select("page_id", F.posexplode(F.concat(covers, normal)).alias("pos", "card"))
    return ex.select("page_id", F.col("pos").cast("bigint").alias("pos"), "card")


def _cards(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    link = F.concat(F.lit("https://cards.example/"), F.col("user_id").cast("string"), F.lit("/"),
                    F.col("event_id").cast("string"),
                    F.when(F.col("event_type") != "error", F.concat(F.lit(PERMALINK_MARK), k.cast("string")))
                    .otherwise(F.lit("")))
    return e.select(F.concat(F.lit("https://cards.example/u/"), F.col("user_id").cast("string")).alias("page_url"),
                    "event_id", "ts", "event_type", "value", k.alias("k"), link.alias("link"))


CARDS_SQL = f"""
WITH c AS (SELECT 'https://cards.example/u/' || CAST(user_id AS VARCHAR) AS page_url, event_id, ts, event_type, value,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  'https://cards.example/' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR)
    || CASE WHEN event_type <> 'error' THEN '{PERMALINK_MARK}' || json_extract_string(props, '$.k') ELSE '' END AS link,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS pos
  FROM events)"""


@query("feed_permalink", CARDS_SQL + f""",
cuts AS (SELECT page_url, min(pos) AS cut FROM c WHERE NOT contains(link, '{PERMALINK_MARK}') GROUP BY page_url)
SELECT c.page_url, c.event_id, split_part(c.link, 'ref=home', 1) || 'type=comment' AS permalink
FROM c LEFT JOIN cuts USING (page_url) WHERE cuts.cut IS NULL OR c.pos < cuts.cut""")
def q_feed_permalink(spark, d):
    """FEED6a: a card without a permalink stops the page; the permalink is
    the link before 'ref=home' plus 'type=comment'."""
    c = _cards(spark, d)
    kept = inc.take_while(c, "page_url", inc.newest_first(), ~F.col("link").contains(PERMALINK_MARK))
    return kept.select("page_url", "event_id",
                       F.concat(F.substring_index("link", "ref=home", 1), F.lit("type=comment")).alias("permalink"))


@query("feed_counter_default", CARDS_SQL + f""",
e AS (SELECT event_id, CASE event_type WHEN 'error' THEN ems[1:5] WHEN 'signup' THEN ems[1:7] ELSE ems END AS ems FROM (
  SELECT event_id, event_type, ['', '', '',
     CASE WHEN k % 3 = 0 THEN '{LABEL_FORWARD}' ELSE CAST(k AS VARCHAR) END, '',
     CASE WHEN event_type = 'click' THEN '{SHIFT_MARK}' ELSE CAST(event_id % 13 AS VARCHAR) END,
     CAST(event_id % 17 AS VARCHAR),
     CASE WHEN k % 4 = 0 THEN '{LABEL_LIKE}' ELSE CAST(k * 2 AS VARCHAR) END] AS ems FROM c) x)
SELECT event_id,
  CASE WHEN len(ems) < 4 OR starts_with(coalesce(ems[4], ''), '{LABEL_FORWARD}') THEN 0 ELSE TRY_CAST(trim(ems[4]) AS INTEGER) END AS forwards,
  CASE WHEN len(ems) < 6 THEN 0
       WHEN starts_with(coalesce(CASE WHEN trim(ems[6]) = '{SHIFT_MARK}' THEN ems[7] ELSE ems[6] END, ''), '{LABEL_COMMENT}') THEN 0
       ELSE TRY_CAST(trim(CASE WHEN trim(ems[6]) = '{SHIFT_MARK}' THEN ems[7] ELSE ems[6] END) AS INTEGER) END AS comments,
  CASE WHEN len(ems) < 8 OR starts_with(coalesce(ems[8], ''), '{LABEL_LIKE}') THEN 0 ELSE TRY_CAST(trim(ems[8]) AS INTEGER) END AS likes
FROM e""")
def q_feed_counter_default(spark, d):
    """FEED6b / FEED9: forwards = cell 3, comments = cell 5 (6 after the
    shift mark), likes = cell 7; missing cells or bare labels -> 0."""
    c = _cards(spark, d)
    k = F.col("k")
    ems = F.array(F.lit(""), F.lit(""), F.lit(""),
                  F.when(k % 3 == 0, F.lit(LABEL_FORWARD)).otherwise(k.cast("string")), F.lit(""),
                  F.when(F.col("event_type") == "click", F.lit(SHIFT_MARK))
                  .otherwise((F.col("event_id") % 13).cast("string")),
                  (F.col("event_id") % 17).cast("string"),
                  F.when(k % 4 == 0, F.lit(LABEL_LIKE)).otherwise((k * 2).cast("string")))
    ems = (F.when(F.col("event_type") == "error", F.slice(ems, 1, 5))
           .when(F.col("event_type") == "signup", F.slice(ems, 1, 7)).otherwise(ems))
    x = c.select("event_id", ems.alias("ems"))
    return x.select("event_id", counter(F.col("ems"), 3, LABEL_FORWARD).alias("forwards"),
                    counter(F.col("ems"), 5, LABEL_COMMENT, shift_idx=6).alias("comments"),
                    counter(F.col("ems"), 7, LABEL_LIKE).alias("likes"))


@query("feed_trim_header_footer", """
WITH r AS (SELECT page_id, regexp_extract_all(html, '<p>(.*?)</p>', 1) AS rows FROM pages),
ex AS (SELECT page_id, len(rows) AS n, unnest(range(len(rows))) AS pos, unnest(rows) AS row FROM r)
SELECT page_id, CAST(pos AS INTEGER) AS pos, regexp_replace(row, '<[^>]*>', '', 'g') AS title,
       contains(row, '<b>') AS icon,
       TRY_CAST(split_part(CAST(length(row) AS VARCHAR) || '/' || CAST(pos AS VARCHAR), '/', 1) AS INTEGER) AS read_count,
       TRY_CAST(split_part(CAST(length(row) AS VARCHAR) || '/' || CAST(pos AS VARCHAR), '/', 2) AS INTEGER) AS comment_count
FROM ex WHERE pos > 0 AND pos < n - 1""")
def q_feed_trim_header_footer(spark, d):
    """FEED8: table rows minus the first and last; title, icon flag and a
    'read/comment' cell split on '/'."""
    p = table(spark, d, "pages").select("page_id", extract.paragraphs("html").alias("rows"))
    ex = p.select("page_id", F.size("rows").alias("n"), F.posexplode("rows").alias("pos", "row"))
    cell = F.concat(F.length("row").cast("string"), F.lit("/"), F.col("pos").cast("string"))
    parts = F.split(cell, "/")
    return ex.where((F.col("pos") > 0) & (F.col("pos") < F.col("n") - 1)).select(
        "page_id", F.col("pos").cast("int").alias("pos"), extract.text_of("row").alias("title"),
        F.col("row").contains("<b>").alias("icon"), parts.getItem(0).try_cast("int").alias("read_count"),
        parts.getItem(1).try_cast("int").alias("comment_count"))


@query("feed_links_hit_miss", standins.with_ctes("page_store") + f""",
l AS (SELECT page_id, unnest(range(len(links))) AS pos, unnest(links) AS link FROM (
  SELECT page_id, list_concat([url], list_transform(regexp_extract_all(html, {LI_HREF}, 1),
      lambda h: CASE WHEN h LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || h ELSE h END)) AS links
  FROM page_store) x),
j AS (SELECT l.*, s.html FROM l LEFT JOIN page_store s ON s.row_key = l.link)
SELECT page_id, CAST(pos AS INTEGER) AS pos, link, NOT (html IS NULL OR html = '') AS hit,
       CASE WHEN html IS NULL OR html = '' THEN {crawl_task_sql('40003', 'link', '0')} END AS task
FROM j""")
def q_feed_links_hit_miss(spark, d):
    """FEED10 / JOB11: the author page's links (its canonical url first,
    then list links) -> stored page hit, or a crawl task."""
    s = standins.page_store(spark, d)
    links = F.concat(F.array(F.col("url")), F.transform(F.regexp_extract_all("html", F.lit(extract.LI_HREF), 1),
                                                        lambda h: extract.absolute(F.col("url"), h)))
    ex = s.select("page_id", F.posexplode(links).alias("pos", "link"))
    lk = lookup.lookup_by_url(ex, s, "link", ("html",))
    miss = lookup.is_miss(lookup.MISS_NULL_OR_EMPTY, url=None)
    return lk.select("page_id", F.col("pos").cast("int").alias("pos"), "link", (~miss).alias("hit"),
                     F.when(miss, messages.crawl_task(F.lit(40003), "link", schemas.RESULT_CRAWL)).alias("task"))


MONTH = "1996-05"


@query("feed_month_filter", f"""
SELECT o_orderkey, '{schemas.URLS[40003]['article']}' || CAST(o_orderkey AS VARCHAR) AS url
FROM orders WHERE contains(strftime(o_orderdate, '%Y-%m-%d'), '{MONTH}')""")
def q_feed_month_filter(spark, d):
    """FEED11: title links whose sibling date contains the month (a
    parameter, Q13)."""
    o = table(spark, d, "orders")
    return o.where(F.date_format("o_orderdate", "yyyy-MM-dd").contains(MONTH)).select(
        "o_orderkey", messages.build_url(schemas.URLS[40003]["article"], "o_orderkey").alias("url"))


@query("grf_author_links", standins.with_ctes("page_store") + f""",
l AS (SELECT DISTINCT regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/' || t AS author_url
      FROM (SELECT url, unnest(regexp_extract_all(html, {LI_TEXT}, 1)) AS t FROM page_store) x
      UNION SELECT url FROM page_store),
known AS (SELECT url FROM page_store WHERE page_id % 2 = 0)
SELECT author_url, CASE WHEN html <> '' THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS name,
       CASE WHEN html IS NULL OR html = '' THEN {crawl_task_sql('40003', 'author_url', '0')} END AS task
FROM l LEFT JOIN page_store s ON s.row_key = author_url WHERE author_url NOT IN (SELECT url FROM known)""")
def q_grf_author_links(spark, d):
    """GRF5: author links on list pages (a page also names itself), unseen ones
    only (visited = pages under even ids), each once; a stored page gives the
    author, a missing one a task."""
    s = standins.page_store(spark, d)
    links = s.select(F.explode(F.transform(F.regexp_extract_all("html", F.lit(extract.LI_TEXT), 1),
                                           lambda t: F.concat(extract.origin("url"), F.lit("/"), t))).alias("author_url"))
    links = links.unionByName(s.select(F.col("url").alias("author_url")))
    visited = s.where(F.col("page_id") % 2 == 0).select(F.col("url").alias("author_url"))
    new = inc.visited_new(links, visited, "author_url")
    lk = lookup.lookup_by_url(new, s, "author_url")
    miss = lookup.is_miss(lookup.MISS_NULL_OR_EMPTY, url=None)
    return lk.select("author_url", F.when(~miss, extract.title("page_html")).alias("name"),
                     F.when(miss, messages.crawl_task(F.lit(40003), "author_url", schemas.RESULT_CRAWL)).alias("task"))


@query("job_post_fill", CARDS_SQL + f""",
e AS (SELECT page_url, event_id, ts, k, event_type,
  ['', '', '', CASE WHEN k % 3 = 0 THEN '{LABEL_FORWARD}' ELSE CAST(k AS VARCHAR) END, '',
   CAST(event_id % 13 AS VARCHAR), CAST(event_id % 17 AS VARCHAR),
   CASE WHEN k % 4 = 0 THEN '{LABEL_LIKE}' ELSE CAST(k * 2 AS VARCHAR) END] AS ems FROM c)
SELECT page_url, event_id, split_part(link_url, 'ref=home', 1) || 'type=comment' AS url,
  CAST((epoch_us(ts) // 1000) // 1000 AS BIGINT) AS ts_s, '' AS title,
  CASE WHEN starts_with(ems[4], '{LABEL_FORWARD}') THEN 0 ELSE TRY_CAST(ems[4] AS INTEGER) END AS retweet,
  CASE WHEN starts_with(ems[6], '{LABEL_COMMENT}') THEN 0 ELSE TRY_CAST(ems[6] AS INTEGER) END AS reply,
  CASE WHEN starts_with(ems[8], '{LABEL_LIKE}') THEN 0 ELSE TRY_CAST(ems[8] AS INTEGER) END AS like_count
FROM (SELECT e.*, c.link AS link_url FROM e JOIN c USING (page_url, event_id)) x""")
def q_job_post_fill(spark, d):
    """JOB12 / FEED9: every card of the scanned users -> post url, ts in
    seconds, retweet / reply / like counters, empty title."""
    c = _cards(spark, d)
    k = F.col("k")
    ems = F.array(F.lit(""), F.lit(""), F.lit(""),
                  F.when(k % 3 == 0, F.lit(LABEL_FORWARD)).otherwise(k.cast("string")), F.lit(""),
                  (F.col("event_id") % 13).cast("string"), (F.col("event_id") % 17).cast("string"),
                  F.when(k % 4 == 0, F.lit(LABEL_LIKE)).otherwise((k * 2).cast("string")))
    x = c.select("page_url", "event_id", "ts", "link", ems.alias("ems"))
    return x.select("page_url", "event_id",
                    F.concat(F.substring_index("link", "ref=home", 1), F.lit("type=comment")).alias("url"),
                    F.floor(ntz_to_millis("ts") / 1000).cast("bigint").alias("ts_s"),
                    F.lit("").alias("title"), counter(F.col("ems"), 3, LABEL_FORWARD).alias("retweet"),
                    counter(F.col("ems"), 5, LABEL_COMMENT).alias("reply"),
                    counter(F.col("ems"), 7, LABEL_LIKE).alias("like_count"))
