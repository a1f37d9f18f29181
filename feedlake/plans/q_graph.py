"""Proof queries: follower-graph expansion (GRF1-GRF4)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import friend_lists, graph, messages, seeds
from ..sources import graph as g
from ..sources import site_pages as site
from ..sources import standins
from .oracle_common import crawl_task_sql
from .registry import query

GATE = schemas.FOLLOWER_GATE_EXPAND
LIST_URL = schemas.URLS[40001]["friend_list"]


def _inputs(spark, d):
    return g.seeds(spark, d), g.edges(spark, d), g.nodes(spark, d), g.has_page(spark, d)


@query("grf_threshold_bfs", g.WITH + f""",
bfs(user_id, hop) USING KEY (user_id) AS (
  SELECT user_id, 0 FROM seeds
  UNION
  SELECT e.dst, min(b.hop) + 1 FROM bfs b JOIN has_page p ON p.user_id = b.user_id
  JOIN edges e ON e.src = b.user_id JOIN nodes n ON n.user_id = e.dst
  WHERE n.followers > {GATE} AND e.dst NOT IN (SELECT user_id FROM recurring.bfs) GROUP BY e.dst),
v AS (SELECT user_id, hop FROM bfs)
SELECT v.user_id, v.hop, n.followers, (p.user_id IS NOT NULL) AS has_page,
  CASE WHEN p.user_id IS NULL THEN to_json({{'id': '', 'attrid': '40001', 'cookie': '', 'referer': '',
       'url': '{LIST_URL}' || CAST(v.user_id AS VARCHAR), 'result': '2'}})::VARCHAR END AS task
FROM v JOIN nodes n USING (user_id) LEFT JOIN has_page p USING (user_id)""")
def q_grf_threshold_bfs(spark, d):
    """GRF1: friends with followers > 100 are saved; stored list pages
    recurse, missing ones become list-page tasks (result 2)."""
    s, e, n, p = _inputs(spark, d)
    v = graph.expand(s, e, n, p, save_gate=F.col("followers") > GATE)
    task = messages.crawl_task(F.lit(40001), messages.build_url(LIST_URL, "user_id"), schemas.RESULT_RECRAWL)
    return v.select("user_id", "hop", "followers", "has_page",
                    F.when(~F.col("has_page"), task).alias("task"))


@query("grf_profile_bfs", g.WITH + f""",
bfs(user_id, hop) USING KEY (user_id) AS (
  SELECT user_id, 0 FROM seeds
  UNION
  SELECT e.dst, min(b.hop) + 1 FROM bfs b JOIN has_page p ON p.user_id = b.user_id
  JOIN edges e ON e.src = b.user_id WHERE e.dst NOT IN (SELECT user_id FROM recurring.bfs) GROUP BY e.dst),
v AS (SELECT user_id, hop FROM bfs)
SELECT v.user_id, v.hop, n.followers, (p.user_id IS NOT NULL) AS has_page,
       (p.user_id IS NULL AND n.followers > {GATE}) AS emit_task
FROM v JOIN nodes n USING (user_id) LEFT JOIN has_page p USING (user_id)""")
def q_grf_profile_bfs(spark, d):
    """GRF2: every unseen friend is saved; a stored page recurses regardless
    of followers; the gate only decides the task for a missing page."""
    s, e, n, p = _inputs(spark, d)
    v = graph.expand(s, e, n, p)
    return v.select("user_id", "hop", "followers", "has_page",
                    (~F.col("has_page") & (F.col("followers") > GATE)).alias("emit_task"))


INFO_URL, FRIENDS_URL = schemas.URLS[40004]["user_info"], schemas.URLS[40004]["friend_list"]


@query("grf_two_edge_bfs", g.WITH + f""",
lists AS (SELECT * FROM edges WHERE src % 7 <> 3 AND src % 11 <> 5),
bfs(user_id, hop) USING KEY (user_id) AS (
  SELECT user_id, 0 FROM seeds
  UNION
  SELECT e.dst, min(b.hop) + 1 FROM bfs b JOIN has_page p ON p.user_id = b.user_id
  JOIN lists e ON e.src = b.user_id WHERE e.dst NOT IN (SELECT user_id FROM recurring.bfs) GROUP BY e.dst),
v AS (SELECT user_id, hop, CAST(user_id AS VARCHAR) AS s FROM bfs)
SELECT v.user_id, v.hop, (i.user_id IS NOT NULL) AS info_hit, (p.user_id IS NOT NULL) AS list_hit,
       (p.user_id IS NOT NULL AND v.user_id % 11 <> 5 AND v.user_id NOT IN (SELECT src FROM lists)) AS empty_list,
       CASE WHEN i.user_id IS NULL THEN {crawl_task_sql('40004', f"'{INFO_URL}' || s", '0')} END AS info_task,
       {crawl_task_sql('40004', f"'{FRIENDS_URL}' || s", 'CASE WHEN p.user_id IS NULL THEN 0 WHEN v.user_id % 11 = 5 THEN 2 ELSE 1 END')} AS list_task
FROM v LEFT JOIN has_info i USING (user_id) LEFT JOIN has_page p USING (user_id)""")
def q_grf_two_edge_bfs(spark, d):
    """GRF3: each friend yields an info lookup and a list lookup; a stored list (XML)
    recurses and is acknowledged (1), also when it is empty; one that cannot be parsed
    is taken again (2); a miss of either kind becomes a task (0)."""
    pages = g.friend_list_pages(spark, d)
    e, status = friend_lists.parse(pages)
    v = graph.expand(g.seeds(spark, d), e, g.nodes(spark, d), pages.select("user_id"))
    info = g.has_info(spark, d).withColumn("info_hit", F.lit(True))

    def task(prefix, result):
        return messages.crawl_task(F.lit(40004), messages.build_url(prefix, "user_id"), result)

    hit = F.coalesce("info_hit", F.lit(False))
    return (v.join(info, "user_id", "left").join(status, "user_id", "left")
            .select("user_id", "hop", hit.alias("info_hit"), F.col("has_page").alias("list_hit"),
                    F.coalesce((F.col("result") == schemas.RESULT_PARSED) & (F.col("total") == 0), F.lit(False)).alias("empty_list"),
                    F.when(~hit, task(INFO_URL, schemas.RESULT_CRAWL)).alias("info_task"),
                    task(FRIENDS_URL, F.coalesce("result", F.lit(schemas.RESULT_CRAWL))).alias("list_task")))


@query("grf_seeds", g.WITH.replace("WITH RECURSIVE", "WITH") + """
SELECT nation, user_id FROM (SELECT *, row_number() OVER (PARTITION BY nation
  ORDER BY followers DESC, user_id DESC) AS rn FROM nodes) t WHERE rn = 1""")
def q_grf_seeds(spark, d):
    """GRF4: one seed per panel (nation): the user with most followers."""
    n = g.nodes(spark, d)
    return n.groupBy("nation").agg(F.max_by("user_id", F.struct("followers", "user_id")).alias("user_id"))


W_USERS = standins.with_ctes("users")
PORTAL, WRITERS = schemas.URLS[40002]["home_page"], schemas.URLS[40004]


@query("grf_panel_seeds", W_USERS + f"""
SELECT '{PORTAL}?seen=' || CAST(user_id // {site.PANEL_USERS} AS VARCHAR) AS page_url, CAST(user_id % 4 AS INTEGER) AS panel,
  CAST(row_number() OVER (PARTITION BY user_id // {site.PANEL_USERS}, user_id % 4 ORDER BY user_id) - 1 AS INTEGER) AS pos,
  {crawl_task_sql('40002', f"'{PORTAL}' || CAST(user_id AS VARCHAR) || '{schemas.FOCUS_LIST}'", '0')} AS task
FROM users WHERE user_id % 4 < 3""")
def q_grf_panel_seeds(spark, d):
    """GRF4 (40002): three panels of landed home pages, read in one walk, each by its own
    link rule -> tasks for the accounts their users follow."""
    return seeds.focus_tasks(site.blog_portals(spark, d))


@query("grf_panel_users", W_USERS + f""",
l AS (SELECT *, CAST(user_id AS VARCHAR) AS s FROM users WHERE user_id % 2 = 0),
i AS (SELECT s, '{WRITERS["user_info"]}' || s AS url, name, user_id % 6 <> 5 AND user_id % 11 <> 0 AS hit FROM l),
f AS (SELECT s, '{WRITERS["friend_list"]}' || s AS url, user_id % 3 <> 1 AS hit, user_id % 4 AS n, user_id % 11 = 5 AS broken FROM l)
SELECT s AS user_id, 'info' AS kind, url, hit, CASE WHEN hit THEN name END AS name, CAST(NULL AS BIGINT) AS friends,
  CASE WHEN NOT hit THEN {crawl_task_sql('40004', 'url', '0')} END AS task FROM i
UNION ALL
SELECT s, 'friends', url, hit, NULL, CASE WHEN hit AND NOT broken THEN n END,
  {crawl_task_sql('40004', 'url', 'CASE WHEN NOT hit THEN 0 WHEN broken THEN 2 ELSE 1 END')} FROM f""")
def q_grf_panel_users(spark, d):
    """GRF4 (40004): users of the home page's panel -> info document and friend list,
    read where stored, asked for where not."""
    store = site.site_pages(spark, d).unionByName(site.friend_pages(spark, d))
    return seeds.panel_users(site.writer_portals(spark, d), store)


@query("msg_top_pages", W_USERS + f""",
t AS (SELECT *, row_number() OVER (ORDER BY followers_count DESC, user_id) - 1 AS rn FROM users),
w AS (SELECT CAST(user_id AS VARCHAR) AS s, rn // {site.TOP_USERS} + 1 AS no, CAST(rn % {site.TOP_USERS} AS INTEGER) AS pos FROM t
      WHERE rn < {site.TOP_USERS * schemas.TOP_PAGES_40004} AND rn // {site.TOP_USERS} <> 3),
p AS (SELECT unnest(range(1, {schemas.TOP_PAGES_40004} + 1)) AS no),
k AS (SELECT * FROM (VALUES ('friends', '{WRITERS["friend_list"]}'), ('info', '{WRITERS["user_info"]}')) v(kind, prefix)),
a AS (SELECT '{WRITERS["top_page"]}' || CAST(no AS VARCHAR) AS page_url, w.s, w.pos FROM p LEFT JOIN w USING (no))
SELECT page_url, pos, s AS user_id, kind, {crawl_task_sql('40004', 'prefix || s', '0')} AS task FROM a, k WHERE s IS NOT NULL
UNION ALL
SELECT page_url, NULL, NULL, NULL, {crawl_task_sql('40004', 'page_url', '0')} FROM a WHERE s IS NULL""")
def q_msg_top_pages(spark, d):
    """MSG10 and GRF4 (40004): the generated pages 1..5 of top writers -> two tasks a writer."""
    return seeds.top_writer_tasks(spark, site.top_pages(spark, d))
