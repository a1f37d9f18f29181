"""Proof queries: batch jobs (JOB1-JOB14)."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import schemas
from ..sources import standins
from ..operators.keyed_tables import BucketTable
from ..session import scratch_path
from ..sources import page_store
from ..sources import site_pages as site
from ..sources.site_pages import site_pages
from ..sources.tables import table
from . import jobs
from .oracle_common import crawl_task_sql
from .q_platform_pages import DETAIL_CTE
from .q_text import DIGEST_SQL
from .registry import query

W = standins.with_ctes("articles", "page_store", "users", "user_rows")
K = schemas.TOPK_ARTICLES
ARTICLE_TEXT = "regexp_replace(regexp_extract({h}, '<article>(.*?)</article>', 1), '<[^>]*>', '', 'g')"
TITLE = "regexp_extract({h}, '<title>([^<]*)</title>', 1)"


def _inputs(spark, d) -> jobs.Inputs:
    """Stand-ins for the jobs' tables."""
    orders, supplier = table(spark, d, "orders"), table(spark, d, "supplier")
    return jobs.Inputs(
        spark, standins.articles(spark, d), standins.page_store(spark, d), standins.users(spark, d),
        standins.user_rows(spark, d),
        orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("user_id")),
        supplier.select(F.col("s_suppkey").alias("user_id"), F.concat(
            F.lit('{"count":'), F.col("s_acctbal").cast("bigint").cast("string"), F.lit("}")).alias("body")))


def _site_inputs(spark, d) -> jobs.Inputs:
    """The same with the platforms' own pages as the page table."""
    return replace(_inputs(spark, d), pages=site_pages(spark, d))


def _detail_inputs(spark, d) -> jobs.Inputs:
    """The same with 40005's detail pages as the page table."""
    return replace(_inputs(spark, d), pages=site.detail_pages(spark, d))


TODO_40005 = f"""{DETAIL_CTE},
top AS (SELECT * FROM articles WHERE platform_id = 40005 ORDER BY ts DESC, url LIMIT {K}),
todo AS (SELECT t.platform_id, t.url, substring(s.body, 1, 200) AS summary, s.body IS NULL AS failed
         FROM top t LEFT JOIN detail s USING (url) WHERE t.summary IS NULL)"""


@query("job_backfill_200", W + f""",{TODO_40005}
SELECT url, summary, CASE WHEN failed THEN {crawl_task_sql('platform_id', 'url', '2')} END AS task FROM todo""")
def q_job_backfill_200(spark, d):
    """JOB1 through ART5."""
    return jobs.backfill_200(_detail_inputs(spark, d))


@query("job_backfill_200_write", W + f""",{TODO_40005}
SELECT 'row' AS kind, a.url, CASE WHEN NOT t.failed THEN t.summary ELSE a.summary END AS summary, CAST(NULL AS VARCHAR) AS task
FROM articles a LEFT JOIN todo t USING (url) WHERE a.platform_id = 40005
UNION ALL
SELECT 'task', NULL, NULL, {crawl_task_sql('platform_id', 'url', '2')} FROM todo WHERE failed""")
def q_job_backfill_200_write(spark, d):
    """JOB1 with its writes (SNK6, replayed once): the articles after the update, and the tasks."""
    t = _detail_inputs(spark, d)
    root = scratch_path(spark, "backfill")
    table = BucketTable(spark, f"{root}/articles", ["url"], "url string, summary string", 16)
    table.create(t.articles.where("platform_id = 40005").select("url", "summary"))
    for version in (1, 1):
        jobs.write_summaries(t, table, version, root)
    tasks = spark.read.text(f"{root}/tasks/version=1").withColumnRenamed("value", "task")
    return table.current().select(F.lit("row").alias("kind"), "url", "summary").unionByName(
        tasks.select(F.lit("task").alias("kind"), "task"), allowMissingColumns=True)


@query("job_backfill_300", W + f""",
newest AS (SELECT * FROM articles WHERE platform_id = 40001 ORDER BY ts DESC, url LIMIT {K}),
hits AS (SELECT t.url, s.html FROM newest t JOIN page_store s ON s.row_key = t.url
         WHERE t.summary IS NULL AND s.html IS NOT NULL AND s.html <> ''),
documents AS (SELECT url AS doc_id, {ARTICLE_TEXT.format(h='html')} AS text FROM hits),
{DIGEST_SQL}
SELECT d.doc_id AS url, dg.digest,
       CASE WHEN length(dg.digest) > 300 THEN substring(dg.digest, 1, 300) ELSE dg.digest END AS summary
FROM documents d LEFT JOIN dg USING (doc_id)""")
def q_job_backfill_300(spark, d):
    """JOB2."""
    return jobs.backfill_300(_inputs(spark, d))


@query("job_history_missing", W + """
SELECT a.url, CAST(length(s.html) AS INTEGER) AS content_len, md5(s.html) AS content_md5 FROM articles a LEFT JOIN page_store s ON s.row_key = a.url
WHERE a.summary IS NULL""")
def q_job_history_missing(spark, d):
    """JOB3."""
    return jobs.history_missing(_inputs(spark, d))


@query("job_recrawl", W + f"""
SELECT url, {crawl_task_sql('platform_id', 'url', '0')} AS task
FROM (SELECT * FROM articles ORDER BY ts DESC, url LIMIT {K}) t""")
def q_job_recrawl(spark, d):
    """JOB4."""
    return jobs.recrawl(_inputs(spark, d))


@query("job_materialise", W + f""",
urls AS (SELECT url, ts FROM articles WHERE platform_id IN (40001, 40002, 40003, 40004) AND summary != '')
SELECT u.url, CAST(length(s.html) AS INTEGER) AS content_len, md5(s.html) AS content_md5, {TITLE.format(h='s.html')} AS title
FROM urls u JOIN page_store s ON s.row_key = u.url WHERE s.html IS NOT NULL""")
def q_job_materialise(spark, d):
    """JOB5."""
    return jobs.materialise(_inputs(spark, d))


@query("job_content_table", W + """,
urls AS (SELECT url, ts FROM articles WHERE platform_id IN (40001, 40002, 40003, 40004) AND summary != ''),
found AS (SELECT u.url, u.ts, CASE WHEN u.ts % 4 = 1 THEN s.html || '<!-- old -->' ELSE s.html END AS content
          FROM urls u JOIN page_store s ON s.row_key = u.url WHERE s.html IS NOT NULL)
SELECT url, CAST(length(content) AS INTEGER) AS content_len, md5(content) AS content_md5, CAST(CASE WHEN ts % 4 = 1 THEN 1 ELSE 2 END AS INTEGER) AS run FROM found""")
def q_job_content_table(spark, d):
    """JOB5 with its write (SNK8), over a page store in buckets whose html is not shuffled:
    a run over older pages and all articles, then one over the pages as they are and half
    of the articles, replayed once. The table keeps the later content of each url."""
    t, buckets = _inputs(spark, d), 16
    old = t.pages.withColumn("html", F.concat("html", F.lit("<!-- old -->")))
    table = BucketTable(spark, scratch_path(spark, "contents"), ["url"], "url string, content string, run int", 16)
    for version, pages, articles in ((1, old, t.articles), (2, t.pages, t.articles.where("ts % 4 <> 1"))):
        store = page_store.write_bucketed(pages.select("table_name", "row_key", "url", "html"), page_store.fresh_name("pages"),
                                          buckets, scratch_path(spark, "page-store"))
        for _ in range(version):   # the second run is replayed
            jobs.write_contents(replace(t, pages=store, articles=articles, page_buckets=buckets), table, version)
    return table.current().select("url", F.length("content").alias("content_len"), F.md5("content").alias("content_md5"), "run")


def _null(*types: str) -> str:
    return ", ".join(f"CAST(NULL AS {t})" for t in types)


BLOG, HOME, LISTS = (schemas.URLS[p][k] for p, k in ((40004, "blog"), (40002, "home_page"), (40002, "article_list")))
INFO, IMAGE = schemas.URLS[40004]["user_info"], schemas.URLS[40004]["image"]


@query("job_vip_home", W + f""",
cand AS (SELECT DISTINCT user_id FROM user_rows WHERE followers_count > 500 OR vip),
lk AS (SELECT c.user_id, u.name, u.segment, '{HOME}' || CAST(c.user_id AS VARCHAR) AS page_url,
         u.user_id IS NULL OR c.user_id % 5 = 4 AS miss FROM cand c LEFT JOIN users u USING (user_id))
SELECT CAST(user_id AS VARCHAR) AS user_id, name, 'likes ' || segment AS introduction, user_id % 3 = 0 AS vip,
       CAST(NULL AS VARCHAR) AS task FROM lk WHERE NOT miss
UNION ALL
SELECT CAST(user_id AS VARCHAR), {_null('VARCHAR', 'VARCHAR', 'BOOLEAN')}, {crawl_task_sql('40002', 'page_url', '0')} FROM lk WHERE miss""")
def q_job_vip_home(spark, d):
    """JOB6 through PROF1."""
    return jobs.vip_home(_site_inputs(spark, d))


@query("job_blog_pages", W + f""",
lk AS (SELECT *, CAST(user_id AS VARCHAR) AS s, '{LISTS}' || CAST(user_id AS VARCHAR) AS first, user_id % 7 = 6 AS miss FROM users WHERE vip),
more AS (SELECT *, first || '?page=' || CAST(page AS VARCHAR) AS list, (user_id + page) % 5 = 0 AS gone
         FROM (SELECT *, unnest(range(2, user_id % 4 + 2)) AS page FROM lk WHERE NOT miss) t),
art AS (SELECT *, '{HOME}' || s || '/article/' || CAST(page * 10 + k AS VARCHAR) AS page_url, (user_id + k) % 4 = 3 AS lost,
          user_id % 17 = 0 OR user_id % 11 = 0 AS bad
        FROM (SELECT *, unnest(range((user_id + page) % 3)) AS k FROM more WHERE NOT gone) t WHERE (user_id + page + k) % 3 = 1)
SELECT page_url, CASE WHEN NOT bad THEN s END AS user_id, CASE WHEN NOT bad THEN name END AS title,
  CASE WHEN NOT bad THEN user_id % 2 = 0 END AS recommend, CASE WHEN NOT bad THEN '2016-05-11 10:00' END AS time,
  CASE WHEN NOT bad THEN CAST(user_id % 13 AS INTEGER) END AS reposts, CASE WHEN NOT bad THEN CAST(user_id % 7 AS INTEGER) END AS comments,
  CASE WHEN bad THEN {crawl_task_sql('40002', 'page_url', '0')} END AS task FROM art WHERE NOT lost
UNION ALL
SELECT page_url, {_null('VARCHAR', 'VARCHAR', 'BOOLEAN', 'VARCHAR', 'INTEGER', 'INTEGER')}, {crawl_task_sql('40002', 'page_url', 'result')}
FROM (SELECT first AS page_url, CASE WHEN miss THEN 0 ELSE 1 END AS result FROM lk
      UNION ALL SELECT list, 0 FROM more WHERE gone UNION ALL SELECT page_url, 0 FROM art WHERE lost) x""")
def q_job_blog_pages(spark, d):
    """JOB7 through FEED11 and ART6."""
    return jobs.blog_pages(_site_inputs(spark, d))


@query("job_vip_fill", W + f""",
cand AS (SELECT DISTINCT user_id FROM user_rows WHERE (recommend > 6 OR marrow > 0 OR vip_level > 0)
         AND user_id NOT IN (SELECT user_id FROM users WHERE vip)),
lk AS (SELECT c.user_id, CAST(c.user_id AS VARCHAR) AS s, '{INFO}' || CAST(c.user_id AS VARCHAR) AS page_url, u.* EXCLUDE (user_id),
         u.user_id IS NULL OR c.user_id % 6 = 5 OR c.user_id % 11 = 0 AS miss FROM cand c LEFT JOIN users u USING (user_id))
SELECT s AS user_id, name, CAST(followers_count AS INTEGER) AS followers_count, 'p' || CAST(nation_key AS VARCHAR) AS introduction,
  CAST(CASE WHEN nation_key % 4 <> 0 THEN nation_key % 5 ELSE 0 END AS INTEGER) AS marrow,
  CAST(CASE WHEN nation_key % 5 <> 0 THEN nation_key ELSE 0 END AS INTEGER) AS recommend,
  CAST(CASE WHEN nation_key % 3 <> 0 THEN nation_key % 2 ELSE 0 END AS INTEGER) AS vip,
  '{BLOG}' || s AS home_page, '{IMAGE}' || 'r' || CAST(nation_key AS VARCHAR) AS portrait, CAST(NULL AS VARCHAR) AS task
FROM lk WHERE NOT miss
UNION ALL
SELECT s, {_null('VARCHAR', 'INTEGER', 'VARCHAR', 'INTEGER', 'INTEGER', 'INTEGER', 'VARCHAR', 'VARCHAR')},
  {crawl_task_sql('40004', 'page_url', '0')} FROM lk WHERE miss""")
def q_job_vip_fill(spark, d):
    """JOB8 through PROF8."""
    return jobs.vip_fill(_site_inputs(spark, d))


@query("job_article_fill", W + f""",
cand AS (SELECT DISTINCT user_id FROM user_rows WHERE vip),
lk AS (SELECT c.user_id, CAST(c.user_id AS VARCHAR) AS s, '{BLOG}' || CAST(c.user_id AS VARCHAR) AS page_url, u.name,
         u.user_id IS NULL OR c.user_id % 5 = 3 AS miss FROM cand c LEFT JOIN users u USING (user_id)),
ex AS (SELECT *, user_id % 6 = 0 AND i = 2 AS bad FROM (SELECT *, unnest(range(1, user_id % 5 + 1)) AS i FROM lk WHERE NOT miss) t)
SELECT page_url, CAST(i AS INTEGER) AS pos, CASE WHEN NOT bad THEN s END AS user_id,
  CASE WHEN NOT bad THEN 'title ' || CAST(i AS VARCHAR) || ' of ' || name END AS title,
  CASE WHEN NOT bad THEN 'http://www.taoguba.com.cn/Article/' || s || '/' || CAST(i AS VARCHAR) END AS url,
  CASE WHEN NOT bad THEN i % 2 = 0 END AS recommend, CASE WHEN NOT bad THEN CAST(user_id AS INTEGER) END AS read_count,
  CASE WHEN NOT bad THEN CAST(i AS INTEGER) END AS comment_count, CASE WHEN NOT bad THEN 1468425600000 END AS ts,
  CASE WHEN bad THEN {crawl_task_sql('40004', 'page_url', '2')} END AS task
FROM ex WHERE user_id % 6 <> 0 OR i <= 2
UNION ALL
SELECT page_url, {_null('INTEGER', 'VARCHAR', 'VARCHAR', 'VARCHAR', 'BOOLEAN', 'INTEGER', 'INTEGER', 'BIGINT')},
  {crawl_task_sql('40004', 'page_url', '2')} FROM lk WHERE miss""")
def q_job_article_fill(spark, d):
    """JOB9 through FEED8."""
    return jobs.article_fill(_site_inputs(spark, d))


STATUSES, STATUS = schemas.URLS[40001]["home_page"], schemas.URLS[40001]["status"]


@query("job_missing_articles", W + f""",
lk AS (SELECT *, CAST(user_id AS VARCHAR) AS s, '{STATUSES}' || CAST(user_id AS VARCHAR) AS page_url, user_id % 8 = 7 AS miss FROM users u
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = u.user_id AND o.o_orderpriority = '1-URGENT'))
SELECT page_url, user_id * 10 + k AS id, CASE WHEN k % 2 = 1 THEN '' ELSE 'on ' || segment END AS title,
  '{STATUS}' || CAST(user_id * 10 + k AS VARCHAR) AS url, (1460000000000 + user_id * 60000 + k) // 1000 AS ts_s, s AS user_id,
  CAST(user_id % 13 AS INTEGER) AS retweet, CAST(k AS INTEGER) AS reply, CAST(NULL AS VARCHAR) AS task
FROM (SELECT *, unnest(range(user_id % 3)) AS k FROM lk WHERE NOT miss) t
UNION ALL
SELECT page_url, {_null('BIGINT', 'VARCHAR', 'VARCHAR', 'BIGINT', 'VARCHAR', 'INTEGER', 'INTEGER')},
  {crawl_task_sql('40001', 'page_url', '2')} FROM lk WHERE miss""")
def q_job_missing_articles(spark, d):
    """JOB10 through FEED7."""
    return jobs.missing_articles(_site_inputs(spark, d))


PAID = schemas.URLS[40003]


@query("job_author_fill", W + f""",
lk AS (SELECT *, CAST(user_id AS VARCHAR) AS s, '{PAID["author"]}' || CAST(user_id AS VARCHAR) AS author, user_id % 5 = 1 AS miss,
         user_id % 10 = 7 AS unlisted, user_id % 13 = 0 AND user_id % 3 = 2 AS torn FROM users),
art AS (SELECT *, '{PAID["article"]}' || CAST(user_id * 10 + k AS VARCHAR) AS page_url, (user_id + k) % 4 = 2 AS lost, user_id % 19 = 0 AS bad
        FROM (SELECT *, unnest(range(user_id % 3)) AS k FROM lk WHERE NOT miss AND NOT unlisted) t WHERE NOT (torn AND k = 1))
SELECT page_url, CASE WHEN NOT bad THEN s END AS user_id, CASE WHEN NOT bad THEN name END AS title,
  CASE WHEN NOT bad THEN CAST(user_id * 2 AS INTEGER) END AS read_count,
  CASE WHEN NOT bad THEN CAST(CASE WHEN user_id % 3 = 0 THEN user_id % 50 ELSE 0 END AS INTEGER) END AS buy_count,
  CASE WHEN NOT bad THEN CAST(CASE WHEN user_id % 4 = 0 THEN (user_id % 9) + 0.5 ELSE 0 END AS DOUBLE) END AS price,
  CASE WHEN NOT bad THEN CAST(1468463935 AS BIGINT) END AS ts_s, CASE WHEN bad THEN {crawl_task_sql('40003', 'page_url', '0')} END AS task
FROM art WHERE NOT lost
UNION ALL
SELECT page_url, {_null('VARCHAR', 'VARCHAR', 'INTEGER', 'INTEGER', 'DOUBLE', 'BIGINT')}, {crawl_task_sql('40003', 'page_url', 'result')}
FROM (SELECT author AS page_url, 2 AS result FROM lk WHERE miss
      UNION ALL SELECT author, 0 FROM lk WHERE NOT miss AND (unlisted OR torn)
      UNION ALL SELECT page_url, 0 FROM art WHERE lost) x""")
def q_job_author_fill(spark, d):
    """JOB11 through FEED10 and ART7."""
    return jobs.author_fill(replace(_inputs(spark, d), pages=site.author_pages(spark, d)))


@query("job_follower_refresh", W + """
SELECT u.user_id, CASE WHEN s.s_suppkey IS NOT NULL THEN CAST(trunc(s.s_acctbal) AS BIGINT)
                       ELSE u.followers_count END AS followers_count,
       s.s_suppkey IS NOT NULL AS updated
FROM users u LEFT JOIN supplier s ON s.s_suppkey = u.user_id""")
def q_job_follower_refresh(spark, d):
    """JOB13."""
    return jobs.follower_refresh(_inputs(spark, d))
