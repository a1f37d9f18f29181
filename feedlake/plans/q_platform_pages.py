"""Proof queries: profile, article and article-table pages of the platforms
(PROF1, PROF4, FEED8, FEED11, ART6, ART7). The pages are written from ``users``
rows in the platforms' markup; the oracles state the expected fields from those
rows and never read the markup."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import article_pages as ap
from ..operators import platform_pages as pp
from ..operators.keyed_tables import BucketTable
from ..operators.text import spread
from ..session import scratch_path
from ..sources import site_pages as site
from ..sources import standins
from . import jobs
from .oracle_common import crawl_task_sql
from .registry import query

W = standins.with_ctes("users")
MONTH = "2016-05"


def _ids():
    """The user id and its text."""
    return F.col("user_id"), F.col("user_id").cast("string")


def _pages(spark, d, url, html):
    """Pages of all users; the narrow rows are spread, so that a table in few splits is
    not walked by few tasks."""
    return spread(standins.users(spark, d)).select(F.col("user_id").alias("id"), url.alias("page_url"), html.alias("html"))


def _cat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query("prof_page_40002", W + """
SELECT CAST(user_id AS VARCHAR) AS user_id, name, 'likes ' || segment AS introduction, user_id % 3 = 0 AS vip FROM users""")
def q_prof_page_40002(spark, d):
    """PROF1 through a blog home page."""
    p = _pages(spark, d, _cat(schemas.URLS[40002]["home_page"], _ids()[1]), site.blog_home_html())
    x = pp.page_items(p, 40002, "id", "html", pp.PROFILE_SPECS, keep=("page_url",))
    return pp.profile_40002(x, F.col("page_url")).drop("id")


@query("prof_page_40003", W + """
SELECT CAST(user_id AS VARCHAR) AS user_id, 'http://img.example/' || CAST(user_id AS VARCHAR) || '.png' AS portrait, name,
  CAST(user_id % 3 AS INTEGER) AS vip, segment AS field,
  CASE WHEN user_id % 10 <> 0 THEN CAST(user_id * 3 AS INTEGER) END AS followers_count, 'writes on ' || segment AS introduction,
  CASE WHEN user_id % 10 = 0 THEN 0 ELSE 1 END AS result FROM users""")
def q_prof_page_40003(spark, d):
    """PROF4 through an author page: red mark beats blue, a fan count that does
    not parse asks for another crawl."""
    uid, s = _ids()
    mark = F.when(uid % 3 == 0, "").when(uid % 3 == 1, '<i class="moerv-blue"></i>').otherwise(
        '<i class="moerv-blue"></i><i class="moerv-red"></i>')
    html = _cat('<html><div class="author-avatar"><img src="http://img.example/', s, '.png"></div><div class="author-msg"><h2><span>',
                F.col("name"), "</span></h2><p><span>", F.col("segment"), "</span></p></div>", mark, '<b id="fansCount">',
                F.when(uid % 10 == 0, "many").otherwise((uid * 3).cast("string")),
                '</b><table class="anthor_left_bottom"><tr><td>a</td></tr><tr><td>b</td></tr><tr><td>c</td></tr><tr><td>writes on ',
                F.col("segment"), "</td></tr></table></html>")
    p = _pages(spark, d, _cat(schemas.URLS[40003]["author"], s), html)
    x = pp.page_items(p, 40003, "id", "html", pp.PROFILE_SPECS, keep=("page_url",))
    return pp.profile_40003(x, F.col("page_url")).drop("id")


@query("feed_blog_links", W + """
SELECT user_id AS id, CAST(i AS INTEGER) AS pos, 'http://blog.cnfol.com/' || CAST(user_id AS VARCHAR) || '/article/' || CAST(i AS VARCHAR) AS url,
  '2016-0' || CAST(4 + (user_id + i) % 3 AS VARCHAR) || '-11' AS time
FROM (SELECT user_id, unnest(range(user_id % 4)) AS i FROM users) t WHERE (user_id + i) % 3 = 1""")
def q_feed_blog_links(spark, d):
    """FEED11: links of the month on a blog's list page."""
    uid, s = _ids()
    i = F.when(uid % 4 > 0, F.sequence(F.lit(0).cast("long"), uid % 4 - 1)).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(i, lambda k: _cat('<li><a class="ArtTit" href="http://blog.cnfol.com/', s, "/article/", k.cast("string"),
                                         '">t</a><span>2016-0', (4 + (uid + k) % 3).cast("string"), "-11</span></li>"))
    p = _pages(spark, d, _cat(schemas.URLS[40002]["article_list"], s), _cat("<html><ul>", F.array_join(rows, ""), "</ul></html>"))
    return ap.blog_links(p, MONTH)


@query("art_page_40002", W + f"""
SELECT page_url, CASE WHEN NOT bad THEN CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN NOT bad THEN name END AS title,
  CASE WHEN NOT bad THEN user_id % 2 = 0 END AS recommend, CASE WHEN NOT bad THEN time END AS time,
  CASE WHEN NOT bad THEN CAST(user_id % 13 AS INTEGER) END AS reposts, CASE WHEN NOT bad THEN CAST(user_id % 7 AS INTEGER) END AS comments,
  CASE WHEN bad THEN {crawl_task_sql('40002', 'page_url', '0')} END AS task
FROM (SELECT *, 'http://blog.cnfol.com/' || CAST(user_id AS VARCHAR) || '/article/9' AS page_url,
        CASE WHEN user_id % 5 = 0 THEN '2016-04-30 10:00' ELSE '2016-05-02 10:00' END AS time,
        user_id % 17 = 0 OR (user_id % 11 = 0 AND user_id % 5 <> 0) AS bad FROM users) t
WHERE bad OR user_id % 5 <> 0""")
def q_art_page_40002(spark, d):
    """ART6 through article pages: other months give nothing, a page without
    title or with a bad counter gives a recrawl task."""
    uid, s = _ids()
    html = site.blog_article_html(F.when(uid % 5 == 0, "2016-04-30 10:00").otherwise("2016-05-02 10:00"))
    return ap.blog_articles(_pages(spark, d, _cat(schemas.URLS[40002]["home_page"], s, "/article/9"), html), MONTH)


@query("art_page_40003", W + f"""
SELECT page_url, CASE WHEN NOT bad THEN CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN NOT bad THEN name END AS title,
  CASE WHEN NOT bad THEN CAST(user_id * 2 AS INTEGER) END AS read_count,
  CASE WHEN NOT bad THEN CAST(CASE WHEN user_id % 3 = 0 THEN user_id % 50 ELSE 0 END AS INTEGER) END AS buy_count,
  CASE WHEN NOT bad THEN CAST(CASE WHEN user_id % 4 = 0 THEN (user_id % 9) + 0.5 ELSE 0 END AS DOUBLE) END AS price,
  CASE WHEN NOT bad THEN 1468463935 END AS ts_s, CASE WHEN bad THEN {crawl_task_sql('40003', 'page_url', '0')} END AS task
FROM (SELECT *, 'http://moer.jiemian.com/articleDetails.htm?articleId=' || CAST(user_id AS VARCHAR) AS page_url,
             user_id % 19 = 0 AS bad FROM users) t""")
def q_art_page_40003(spark, d):
    """ART7 through article pages: read count, time, buyers (default 0), price
    (default 0.0); a read count that does not parse gives a crawl task."""
    return ap.paid_articles(_pages(spark, d, _cat(schemas.URLS[40003]["article"], _ids()[1]), site.paid_article_html()))


#: What the detail pages of 40005 say, stated from the given pages.
DETAIL_CTE = """
raw AS (SELECT *, regexp_replace(array_to_string(regexp_extract_all(html, '<p>(.*?)</p>', 1), ' '), '<[^>]*>', '', 'g') AS content,
          regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS reason FROM page_store WHERE platform_id = 40005),
detail AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  CASE WHEN html = '' THEN NULL WHEN page_id % 7 = 1 THEN '' WHEN page_id % 11 = 3 THEN NULL ELSE
    trim(regexp_replace(replace(replace(content, '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) || ' ' ||
    trim(regexp_replace(replace(replace(reason, '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) END AS body FROM raw)"""


@query("art_page_40005", standins.with_ctes("page_store") + f""",{DETAIL_CTE}
SELECT url AS page_url, title, body FROM detail""")
def q_art_page_40005(spark, d):
    """ART5 through detail pages: html nested in a script's JSON document, the first
    card's content and reason; broken documents and pages without a card."""
    return ap.card_bodies(site.detail_pages(spark, d).select(F.col("url").alias("page_url"), "html"))


@query("art_page_40004", standins.with_ctes("page_store") + """,
raw AS (SELECT *, regexp_extract(html, '<h1>([^<]*)</h1>', 1) || ' ' ||
          regexp_replace(array_to_string(regexp_extract_all(html, '<p>(.*?)</p>', 1), ' '), '<[^>]*>', '', 'g') AS content,
          regexp_extract_all(html, '<li><a href="/([^"]*)">', 1) AS links, html = '' OR page_id % 9 = 4 AS broken
        FROM page_store WHERE platform_id = 40004)
SELECT url AS page_url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  CASE WHEN NOT broken THEN trim(regexp_replace(replace(replace(content, '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) END AS body,
  CASE WHEN NOT broken THEN array_to_string(list_filter(list_transform(links, lambda x, i:
    CASE WHEN i % 3 = 1 THEN 'http://i.example/' || x WHEN i % 3 = 2 THEN 'http://lazy.example/' || x END), lambda x: x IS NOT NULL), ',') END AS images
FROM raw""")
def q_art_page_40004(spark, d):
    """ART4 through posts: title without the site's name, all content blocks, images of
    the frame by source or lazily loaded address; pages without a frame."""
    return ap.posts_40004(site.post_pages(spark, d).select(F.col("url").alias("page_url"), "html")) \
        .withColumn("images", F.array_join("images", ","))


@query("prof_page_40005", W + f"""
SELECT page_url, CASE WHEN NOT bad THEN s END AS user_id, CASE WHEN NOT bad THEN name END AS name,
  CASE WHEN NOT bad THEN 'http://face/' || s || '.jpg' END AS portrait, CASE WHEN NOT bad THEN 'likes ' || segment END AS introduction,
  CASE WHEN NOT bad THEN CAST(followers_count AS INTEGER) END AS followers_count, CASE WHEN NOT bad THEN user_id % 3 = 0 END AS vip,
  CASE WHEN bad THEN {crawl_task_sql('40005', 'page_url', '2')} END AS task
FROM (SELECT *, CAST(user_id AS VARCHAR) AS s, 'http://weibo.com/' || CAST(user_id AS VARCHAR) AS page_url,
        user_id % 23 = 0 OR user_id % 19 = 0 OR user_id % 17 = 0 OR user_id % 13 = 0 AS bad FROM users) t""")
def q_prof_page_40005(spark, d):
    """PROF9 through home pages: head and counter documents in scripts."""
    p = _pages(spark, d, _cat(schemas.URLS[40005]["home_page"], _ids()[1]), site.card_home_html())
    return pp.profiles_40005(p.select("page_url", "html"))


@query("prof_portrait_write", W + """
SELECT user_id, CASE WHEN user_id % 5 <> 4 AND user_id % 4 IN (0, 3) THEN 'http://pic/' || CAST(user_id AS VARCHAR) || '.png' ELSE 'old' END AS portrait
FROM users""")
def q_prof_portrait_write(spark, d):
    """PROF3 with its write: first image of the home page's picture block -> keyed update
    (SNK6, replayed once); users without such a page or image keep what they had."""
    t = jobs.Inputs(spark, users=standins.users(spark, d), pages=site.site_pages(spark, d))
    table = BucketTable(spark, scratch_path(spark, "portrait_table"), ["user_id"], "user_id bigint, portrait string", 16)
    table.create(t.users.select("user_id", F.lit("old").alias("portrait")))
    for version in (1, 1):
        jobs.write_portraits(t, table, version)
    return table.current()


@query("feed_blog_table", W + f"""
SELECT page_url, CAST(i AS INTEGER) AS pos, CASE WHEN NOT bad THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN NOT bad THEN 'title ' || CAST(i AS VARCHAR) || ' of ' || name END AS title,
  CASE WHEN NOT bad THEN 'http://www.taoguba.com.cn/Article/' || CAST(user_id AS VARCHAR) || '/' || CAST(i AS VARCHAR) END AS url,
  CASE WHEN NOT bad THEN i % 2 = 0 END AS recommend, CASE WHEN NOT bad THEN CAST(user_id AS INTEGER) END AS read_count,
  CASE WHEN NOT bad THEN CAST(i AS INTEGER) END AS comment_count, CASE WHEN NOT bad THEN 1468425600000 END AS ts,
  CASE WHEN bad THEN {crawl_task_sql('40004', 'page_url', '2')} END AS task
FROM (SELECT *, 'http://www.taoguba.com.cn/blog/' || CAST(user_id AS VARCHAR) AS page_url, user_id % 6 = 0 AND i = 2 AS bad
      FROM (SELECT *, unnest(range(1, user_id % 5 + 1)) AS i FROM users) a) t
WHERE user_id % 6 <> 0 OR i <= 2""")
def q_feed_blog_table(spark, d):
    """FEED8 through blog tables: head and foot row left out, every field of a
    row, recrawl task where a row does not parse."""
    html = site.blog_table_html()
    s = _ids()[1]
    return ap.blog_table(_pages(spark, d, _cat(schemas.URLS[40004]["blog"], s), html))
