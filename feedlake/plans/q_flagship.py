"""Proof queries: flagship feed increments, messages, lookups (SRC/MSG/STR).

The oracle states each platform's rules over the items themselves
(``standins.SQL['feed_items']``); it never reads the platform pages."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..sources import standins
from . import flagship
from .oracle_common import PARSED_SQL, PLATFORMS_SQL, article_task_sql
from .registry import query

# ---------------------------------------------------------------- flagship
WALK_SQL = standins.with_ctes("feed_items", "feed_messages") + f""",
platforms AS ({PLATFORMS_SQL}),
parsed AS ({PARSED_SQL.replace("FROM messages", "FROM feed_messages")}),
requests AS (SELECT DISTINCT g.key_name, g.pos_name FROM parsed g
             JOIN platforms p ON p.platform_id = CAST(g.attr_id AS INTEGER) WHERE g.reason IS NULL),
it AS (SELECT f.*, p.marker_kind AS kind, p.needs_login,
         CASE p.marker_kind WHEN 'ts' THEN CAST(f.ts AS VARCHAR) WHEN 'title' THEN f.title ELSE f.url END AS mark
       FROM feed_items f JOIN platforms p USING (platform_id)),
newest AS (SELECT p, mark AS newest FROM (SELECT *, row_number() OVER (
             PARTITION BY p ORDER BY CASE WHEN kind = 'head' THEN -ts ELSE 0 END, pos) AS r FROM it) x WHERE r = 1),
pages_ AS (SELECT s.page_id AS p, s.url AS page_url, pl.marker_kind AS kind, n.newest
           FROM feed_store s JOIN platforms pl USING (platform_id) LEFT JOIN newest n ON n.p = s.page_id
           WHERE s.html <> ''),
markers AS (SELECT g.page_url, CASE WHEN g.p % 4 = 0 THEN t.mark WHEN g.p % 4 = 1 THEN g.newest
              WHEN g.kind = 'ts' THEN '1' ELSE 'gone' END AS last_key
            FROM pages_ g LEFT JOIN it t ON t.p = g.p AND t.pos = 2 WHERE g.p % 4 <> 2),
hits AS (SELECT g.* FROM pages_ g JOIN feed_store s ON s.page_id = g.p
         JOIN requests r ON r.key_name = s.table_name AND r.pos_name = s.row_key),
walk AS (SELECT it.*, h.newest, m.last_key FROM it JOIN hits h USING (p) LEFT JOIN markers m ON m.page_url = it.page_url)"""

FLAGSHIP_SQL = WALK_SQL + f""",
cuts AS (SELECT p, min(pos) AS cut FROM walk WHERE CASE kind
           WHEN 'ts' THEN ts <= coalesce(CAST(last_key AS BIGINT), 0)
           WHEN 'head' THEN newest IS NOT DISTINCT FROM last_key OR NOT valid
           ELSE mark = last_key END GROUP BY p),
new AS (SELECT w.*, row_number() OVER (PARTITION BY platform_id, url ORDER BY page_url, pos) AS r
        FROM walk w LEFT JOIN cuts USING (p) WHERE (cut IS NULL OR pos < cut) AND keep)
SELECT platform_id, page_url, CAST(pos AS INTEGER) AS pos, user_id, title, url, ts,
       CAST(reposts AS INTEGER) AS reposts, CAST(comments AS INTEGER) AS comments, CAST(likes AS INTEGER) AS likes,
       {article_task_sql('platform_id', 'url', 'needs_login')} AS task
FROM new WHERE r = 1"""


@query("str_flagship", FLAGSHIP_SQL)
def q_str_flagship(spark, d):
    """STR1/STR2 + MSG3 + INC2-INC5 in batch form: each page through its
    platform's extractor and marker rule; new article rows and their tasks."""
    return flagship.feed_increments(spark, d)


@query("inc_marker_table_run", WALK_SQL + """
SELECT coalesce(h.page_url, m.page_url) AS page_url,
  CASE WHEN h.kind = 'ts' THEN CAST(greatest(CAST(m.last_key AS BIGINT), CAST(h.newest AS BIGINT)) AS VARCHAR)
       ELSE coalesce(h.newest, m.last_key) END AS last_key
FROM hits h FULL OUTER JOIN markers m ON h.page_url = m.page_url
WHERE m.page_url IS NOT NULL OR h.newest IS NOT NULL""")
def q_inc_marker_table_run(spark, d):
    """INC1 batch form: one scheduled run over the notices writes articles,
    tasks and the markers that changed; the marker of every page after the run
    is returned, read back through the reader of the next run."""
    from ..session import scratch_path
    root = scratch_path(spark, "increment_runs")
    store, before = standins.feed_store(spark, d), flagship.page_markers(spark, d)
    flagship.run_increment(spark, standins.messages(spark, d, store), store, schemas.platforms(spark), root, 1, before)
    return flagship.marker_log(spark, root).state(2)


@query("feed_platform_items", standins.with_ctes("feed_items") + """
SELECT p AS page_id, platform_id, CAST(pos AS INTEGER) AS pos, title, url, user_id, ts,
       CAST(coalesce(reposts, 0) AS INTEGER) AS reposts, CAST(comments AS INTEGER) AS comments,
       CAST(likes AS INTEGER) AS likes, keep, valid FROM feed_items""")
def q_feed_platform_items(spark, d):
    """FEED1, FEED2, FEED3, FEED5, FEED6 through the platforms' own pages: every
    item of every feed page with all its fields, before any marker rule."""
    from ..operators import platform_items as pi
    s = standins.feed_store(spark, d)
    x = s.select("page_id", "platform_id", F.posexplode(pi.items(F.col("platform_id"), F.col("url"), F.col("html")))
                 .alias("pos", "it"))
    return x.select("page_id", "platform_id", F.col("pos").cast("int").alias("pos"), "it.title", "it.url", "it.user_id",
                    "it.ts", "it.reposts", "it.comments", "it.likes", "it.keep", "it.valid")
