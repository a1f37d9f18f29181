"""Proof queries: incremental feed logic (INC1-INC7) on the row-stored feed
(``feed_events``: one page per user, newest first)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import increments as inc
from ..operators import messages
from ..session import scratch_path
from ..sources import standins
from ..sources.tables import table
from .registry import query

W = standins.with_ctes("feed_events", "feed_markers")
RANKED = W + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY ts DESC, event_id DESC) - 1 AS pos
           FROM feed_events)"""
OUT = "page_url, event_id, url, title, ts_ms"


def _feed(spark, d):
    return standins.feed_events(spark, d), standins.feed_markers(spark, d)


def new_by_title(spark, d):
    f, m = _feed(spark, d)
    return inc.take_until_seen(f, m, "page_url", inc.newest_first(), "title", "last_title")


@query("inc_take_until_seen", RANKED + f""",
cuts AS (SELECT r.page_url, min(r.pos) AS cut FROM ranked r
         JOIN feed_markers m ON r.page_url = m.page_url AND r.title = m.last_title GROUP BY r.page_url)
SELECT {OUT} FROM ranked r LEFT JOIN cuts c USING (page_url) WHERE c.cut IS NULL OR r.pos < c.cut""")
def q_inc_take_until_seen(spark, d):
    """INC2 (title key): items before the first one equal to the marker."""
    return new_by_title(spark, d).select(*OUT.split(", "))


@query("inc_take_until_seen_url", RANKED + f""",
cuts AS (SELECT r.page_url, min(r.pos) AS cut FROM ranked r
         JOIN feed_markers m ON r.page_url = m.page_url AND r.url = m.last_url GROUP BY r.page_url)
SELECT {OUT} FROM ranked r LEFT JOIN cuts c USING (page_url) WHERE c.cut IS NULL OR r.pos < c.cut""")
def q_inc_take_until_seen_url(spark, d):
    """INC2 (url key, platform 40001)."""
    f, m = _feed(spark, d)
    return inc.take_until_seen(f, m, "page_url", inc.newest_first(), "url", "last_url") \
        .select(*OUT.split(", "))


@query("inc_take_while_newer", RANKED + f""",
cuts AS (SELECT r.page_url, min(r.pos) AS cut FROM ranked r LEFT JOIN feed_markers m USING (page_url)
         WHERE r.ts_ms <= coalesce(m.last_ts_ms, 0) GROUP BY r.page_url)
SELECT {OUT} FROM ranked r LEFT JOIN cuts c USING (page_url) WHERE c.cut IS NULL OR r.pos < c.cut""")
def q_inc_take_while_newer(spark, d):
    """INC3: items before the first with ts <= marker ts (0 when none)."""
    f, m = _feed(spark, d)
    return inc.take_while_newer(f, m, "page_url", inc.newest_first(), "ts_ms", "last_ts_ms") \
        .select(*OUT.split(", "))


@query("inc_page_changed", RANKED + f""",
heads AS (SELECT page_url, url AS head_url FROM ranked WHERE pos = 0),
changed AS (SELECT h.page_url FROM heads h LEFT JOIN feed_markers m USING (page_url)
            WHERE m.last_url IS DISTINCT FROM h.head_url),
cuts AS (SELECT page_url, min(pos) AS cut FROM ranked WHERE title LIKE 'error#%' GROUP BY page_url)
SELECT {OUT} FROM ranked r JOIN changed USING (page_url) LEFT JOIN cuts c USING (page_url)
WHERE c.cut IS NULL OR r.pos < c.cut""")
def q_inc_page_changed(spark, d):
    """INC4: pages whose newest url differs from the marker, all items up to
    the first one without a permalink (error items carry none)."""
    f, m = _feed(spark, d)
    valid = ~F.col("title").startswith("error#")
    return inc.page_changed(f, m, "page_url", inc.newest_first(), "url", "last_url", valid) \
        .select(*OUT.split(", "))


@query("inc_argmax_latest", RANKED + """
SELECT page_url, event_id, url, value FROM (
  SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY value DESC, pos ASC) AS rn FROM ranked) t
WHERE rn = 1""")
def q_inc_argmax_latest(spark, d):
    """INC5: per page the item with the largest value; the first in feed
    order wins ties (max_by over a struct, no sort)."""
    f, _ = _feed(spark, d)
    # feed position ascends as (ts, event_id) descend, so the first item in
    # feed order among equal values is the one with the largest (ts, id).
    o = F.struct(F.col("value"), F.col("ts"), F.col("event_id"))
    return f.groupBy("page_url").agg(*[F.max_by(c, o).alias(c) for c in ["event_id", "url", "value"]])


@query("inc_marker_update", RANKED + """,
cuts AS (SELECT r.page_url, min(r.pos) AS cut FROM ranked r
         JOIN feed_markers m ON r.page_url = m.page_url AND r.title = m.last_title GROUP BY r.page_url),
new AS (SELECT r.* FROM ranked r LEFT JOIN cuts c USING (page_url) WHERE c.cut IS NULL OR r.pos < c.cut),
heads AS (SELECT page_url, title AS new_title FROM (
            SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY pos) AS rn FROM new) t WHERE rn = 1)
SELECT coalesce(h.page_url, m.page_url) AS page_url, coalesce(h.new_title, m.last_title) AS last_title,
       (h.new_title IS NOT NULL AND h.new_title IS DISTINCT FROM m.last_title) AS changed
FROM heads h FULL OUTER JOIN feed_markers m ON h.page_url = m.page_url""")
def q_inc_marker_update(spark, d):
    """INC1: next marker per page = newest new item's title; pages with
    nothing new keep their marker."""
    f, m = _feed(spark, d)
    new = inc.take_until_seen(f, m, "page_url", inc.newest_first(), "title", "last_title")
    return inc.update_markers(m, new, "page_url", inc.newest_first(), "title", "last_title")


@query("inc_visited", standins.with_ctes("users") + """
SELECT DISTINCT o_custkey AS user_id FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM users WHERE vip)""")
def q_inc_visited(spark, d):
    """INC6: candidate users (from order rows, with repeats) that are not in
    the visited set (the VIP table), each once."""
    cand = standins.user_rows(spark, d).select("user_id")
    visited = standins.users(spark, d).where("vip").select("user_id")
    return inc.visited_new(cand, visited, "user_id")


@query("inc_visited_log", """
WITH first AS (SELECT DISTINCT user_id FROM events WHERE event_id % 2 = 0)
SELECT 0 AS run, user_id FROM first
UNION ALL
SELECT DISTINCT 1, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM first WHERE user_id % 5 <> 0)""")
def q_inc_visited_log(spark, d):
    """INC6 over two runs with removal: a run takes the candidates that are not in
    the visited log; a page that fails (every fifth user of the first run) is taken
    out of it again and comes back in the next run."""
    events = table(spark, d, "events")
    log = inc.visited_log(spark, scratch_path(spark, "visited"), {"user_id": "bigint"})
    out = []
    for run, candidates in enumerate((events.where("event_id % 2 = 0"), events)):
        new = log.absent(candidates.select("user_id").distinct(), run)
        log.write(new.withColumn("gone", (F.col("user_id") % 5 == 0) & F.lit(run == 0)), run)
        out.append(log.rows(run + 1).where(F.col("run") == run).select(F.col("run").cast("int").alias("run"), "user_id"))
    return out[0].unionByName(out[1])


@query("inc_preload", standins.with_ctes("users") + f"""
SELECT user_id, '{schemas.URLS[40001]['friend_list']}' || CAST(user_id AS VARCHAR) AS url FROM users""")
def q_inc_preload(spark, d):
    """INC7: every known user mapped to its friend-list url (visited seed)."""
    u = standins.users(spark, d)
    return u.select("user_id", messages.build_url(schemas.URLS[40001]["friend_list"], "user_id").alias("url"))


# Conversations as feed pages: one page per conversation, turns newest
# first; the previous crawl saw the first half of every conversation.
CONV_SQL = """
WITH c AS (SELECT conv_id, turn, role, text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1 AS pos FROM conversations),
m AS (SELECT conv_id, max(turn) // 2 AS last_turn FROM conversations GROUP BY conv_id),
cuts AS (SELECT c.conv_id, min(c.pos) AS cut FROM c JOIN m USING (conv_id) WHERE c.turn <= m.last_turn
         GROUP BY c.conv_id)
SELECT c.conv_id, c.turn, c.role, length(c.text) AS text_len, md5(c.text) AS text_md5
FROM c LEFT JOIN cuts USING (conv_id) WHERE cuts.cut IS NULL OR c.pos < cuts.cut"""


@query("inc_conversation_newer", CONV_SQL)
def q_inc_conversation_newer(spark, d):
    """INC3 on the conversations table: per conversation (page), the turns
    newer than the one reached at the previous crawl (half way)."""
    from ..sources.tables import table
    c = table(spark, d, "conversations")
    markers = c.groupBy("conv_id").agg(F.expr("max(turn) div 2").alias("last_turn"))
    kept = inc.take_while_newer(c, markers, "conv_id", F.struct((-F.col("turn")).alias("t")), "turn", "last_turn")
    return kept.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("text_len"),
                       F.md5("text").alias("text_md5"))
