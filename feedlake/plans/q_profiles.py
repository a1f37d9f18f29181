"""Proof queries: profile extraction (PROF1-PROF9)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import extract, lookup, messages, profiles, sinks
from ..sources import graph as g
from ..sources import standins
from .oracle_common import crawl_task_sql
from .registry import query

W = standins.with_ctes("users", "page_store", "profile_index")
MISS = "(page_url IS NULL OR page_html IS NULL OR page_url = '' OR page_html = '')"
TITLE = "regexp_extract(page_html, '<title>([^<]*)</title>', 1)"
LK = """lk AS (SELECT u.user_id, s.url AS page_url, s.html AS page_html FROM users u
        LEFT JOIN profile_index i USING (user_id) LEFT JOIN page_store s ON s.page_id = i.page_id)"""
IMG40001, HOME40001 = schemas.URLS[40001]["image"], schemas.URLS[40001]["home_page"]


def _lk(spark, d):
    u = standins.users(spark, d).select("user_id")
    lk = standins.profile_lookup(spark, d, u)
    return lk, lookup.is_miss(lookup.MISS_NULL_OR_EMPTY)


@query("prof_home_page", W + f""", {LK}
SELECT user_id, substring(page_url, 23) AS url_tail, {TITLE} AS name,
       regexp_replace(regexp_extract(page_html, '<p>(.*?)</p>', 1), '<[^>]*>', '', 'g') AS intro,
       strpos(page_html, '<b>') > 0 AS vip
FROM lk WHERE NOT {MISS}""")
def q_prof_home_page(spark, d):
    """PROF1: id = the url after its first 22 chars, name, intro, vip = badge present."""
    lk, miss = _lk(spark, d)
    h = F.col("page_html")
    return lk.where(~miss).select(
        "user_id", F.substring("page_url", 23, 1 << 20).alias("url_tail"), extract.title(h).alias("name"),
        extract.text_of(F.regexp_extract(h, "<p>(.*?)</p>", 1)).alias("intro"),
        (F.regexp_count(h, F.lit("<b>")) > 0).alias("vip"))


@query("prof_badge_check", W + f""", {LK}
SELECT user_id, strpos(page_html, '<b>') > 0 AS badge,
       {crawl_task_sql('40002', 'page_url', '1')} AS task
FROM lk WHERE NOT {MISS}""")
def q_prof_badge_check(spark, d):
    """PROF2: badge flag; every parsed page is acknowledged (result 1)."""
    lk, miss = _lk(spark, d)
    return lk.where(~miss).select("user_id", (F.regexp_count("page_html", F.lit("<b>")) > 0).alias("badge"),
                                  messages.crawl_task(F.lit(40002), "page_url", schemas.RESULT_PARSED).alias("task"))


@query("prof_portrait_update", W + f""", {LK},
upd AS (SELECT user_id, regexp_extract(page_url, '^(https?://[^/?#]+)', 1)
               || regexp_extract(page_html, '<li><a href="([^"]*)">', 1) AS portrait
        FROM lk WHERE NOT {MISS} AND strpos(page_html, '<li><a href="/') > 0)
SELECT u.user_id, upd.portrait, upd.user_id IS NOT NULL AS updated FROM users u LEFT JOIN upd USING (user_id)""")
def q_prof_portrait_update(spark, d):
    """PROF3: first image of the picture block -> keyed UPDATE of portrait."""
    lk, miss = _lk(spark, d)
    first = F.regexp_extract("page_html", r'<li><a href="([^"]*)">', 1)
    upd = lk.where(~miss & F.col("page_html").contains('<li><a href="/')).select(
        "user_id", F.concat(extract.origin("page_url"), first).alias("portrait"))
    target = standins.users(spark, d).select("user_id").withColumn("portrait", F.lit(None).cast("string"))
    return sinks.keyed_update(target, upd, ["user_id"], ["portrait"])


@query("prof_vip_level", W + f""", {LK}
SELECT user_id,
  CASE WHEN {MISS} THEN NULL WHEN contains({TITLE}, '***') THEN 2 WHEN contains({TITLE}, '%%%') THEN 1 ELSE 0 END AS vip,
  CASE WHEN {MISS} THEN NULL ELSE CAST(len(regexp_extract_all(page_html, '<p>(.*?)</p>', 1)) AS INTEGER) END AS fans,
  {crawl_task_sql('40003', "'" + schemas.URLS[40003]['author'] + "' || CAST(user_id AS VARCHAR)", f"CASE WHEN {MISS} THEN 0 ELSE 1 END")} AS task
FROM lk""")
def q_prof_vip_level(spark, d):
    """PROF4: vip 0/1/2 (red mark beats blue), fans; ack (1) or crawl task (0)."""
    lk, miss = _lk(spark, d)
    t = extract.title("page_html")
    lvl = F.when(miss, F.lit(None)).when(t.contains("***"), 2).when(t.contains("%%%"), 1).otherwise(0)
    url = messages.build_url(schemas.URLS[40003]["author"], "user_id")
    return lk.select("user_id", lvl.cast("int").alias("vip"),
                     F.when(~miss, F.size(extract.paragraphs("page_html"))).alias("fans"),
                     messages.crawl_task(F.lit(40003), url, F.when(miss, schemas.RESULT_CRAWL).otherwise(schemas.RESULT_PARSED)).alias("task"))


def user_list_pages(spark, d):
    """Follower-list JSON pages: one src's friends in chunks of 64 ids."""
    e = g.edges(spark, d)
    n = g.nodes(spark, d)
    u = e.join(n.withColumnRenamed("user_id", "dst"), "dst")
    user = F.struct(
        F.col("dst").alias("id"), F.col("followers").cast("int").alias("followers_count"),
        F.concat(F.lit("s"), F.col("dst").cast("string")).alias("screen_name"),
        F.when(F.col("nation") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("intro "), F.col("nation").cast("string")))
        .alias("description"),
        F.concat(F.lit("a"), F.col("dst").cast("string"), F.lit(".jpg,b"), F.col("dst").cast("string"), F.lit(".jpg"))
        .alias("profile_image_url"))
    pages = (u.select("src", F.expr("dst div 64").alias("chunk"), F.col("dst"), user.alias("u"))
             .groupBy("src", "chunk").agg(F.array_sort(F.collect_list(F.struct("dst", "u"))).alias("a")))
    return pages.select("src", "chunk", F.to_json(F.struct(F.transform("a", lambda x: x["u"]).alias("users")))
                        .alias("doc"))


@query("prof_user_list", g.WITH.replace("WITH RECURSIVE", "WITH") + f""",
u AS (SELECT e.src, e.dst, n.followers, n.nation FROM edges e JOIN nodes n ON n.user_id = e.dst)
SELECT src, CAST(dst AS VARCHAR) AS id, CAST(followers AS INTEGER) AS followers_count, 's' || CAST(dst AS VARCHAR) AS name,
       CASE WHEN nation % 4 = 0 THEN '' ELSE 'intro ' || CAST(nation AS VARCHAR) END AS intro,
       '{IMG40001}' || 'a' || CAST(dst AS VARCHAR) || '.jpg' AS portrait
FROM u""")
def q_prof_user_list(spark, d):
    """PROF5: follower-list JSON -> users; id as a long string; NULL intro
    -> ''; portrait = image prefix + the first of the comma list."""
    p = user_list_pages(spark, d).select("src", F.from_json("doc", schemas.USER_LIST_PAGE).alias("p"))
    x = p.select("src", F.explode("p.users").alias("u"))
    return x.select("src", F.col("u.id").cast("string").alias("id"), F.col("u.followers_count").alias("followers_count"),
                    F.col("u.screen_name").alias("name"), F.coalesce("u.description", F.lit("")).alias("intro"),
                    F.concat(F.lit(IMG40001), F.split("u.profile_image_url", ",").getItem(0)).alias("portrait"))


def _home_html(u):
    prof = F.to_json(F.struct(F.col("user_id").alias("id"), F.col("name").alias("screen_name"),
                              F.col("followers_count").alias("followers_count"),
                              F.concat(F.lit("intro of "), F.col("segment")).alias("description"),
                              F.concat(F.lit("community/"), F.col("user_id").cast("string"),
                                       F.lit("-180x180.jpg!50x50.png")).alias("profile_image_url")))
    return F.concat(F.lit("<html><script>var a=1;</script><script>SNB.profileUser = "), prof,
                    F.lit("</script></html>"))


@query("prof_home_json", W + f"""
SELECT user_id AS id, name, CAST(followers_count AS BIGINT) AS followers, 'intro of ' || segment AS intro,
  '{HOME40001}' || CAST(user_id AS VARCHAR) AS home_page,
  '{schemas.URLS[40001]['vip_image']}' || 'community/' || CAST(user_id AS VARCHAR) || '-180x180.jpg' AS portrait
FROM users""")
def q_prof_home_json(spark, d):
    """PROF6: profile object between literal markers: name, followers, intro,
    home page (the page's own url); portrait = image prefix + image name minus
    the size suffix."""
    u = standins.users(spark, d).select("user_id", "name", "followers_count", "segment")
    html = _home_html(u)
    js = F.substring_index(F.substring_index(html, "SNB.profileUser = ", -1), "</script>", 1)
    p = F.from_json(js, "id BIGINT, screen_name STRING, followers_count BIGINT, description STRING, "
                        "profile_image_url STRING")
    return u.select(p["id"].alias("id"), p["screen_name"].alias("name"), p["followers_count"].alias("followers"),
                    p["description"].alias("intro"), messages.build_url(HOME40001, "user_id").alias("home_page"),
                    profiles.vip_portrait(p["profile_image_url"]).alias("portrait"))


def _info_json(u):
    """User-info JSON (all strings); some keys missing by rule."""
    k = F.col("nation_key")
    parts = [F.lit('{"userID":"'), F.col("user_id").cast("string"), F.lit('","userName":"'), F.col("name"),
             F.lit('","fansNum":"'), F.col("followers_count").cast("string"), F.lit('"'),
             F.when(k % 3 != 0, F.concat(F.lit(',"vipAuth":"'), (k % 2).cast("string"), F.lit('"'))).otherwise(F.lit("")),
             F.when(k % 4 != 0, F.concat(F.lit(',"be":"'), (k % 5).cast("string"), F.lit('"'))).otherwise(F.lit("")),
             F.when(k % 5 != 0, F.concat(F.lit(',"us":"'), k.cast("string"), F.lit('"'))).otherwise(F.lit("")),
             F.lit(',"pe":"p'), k.cast("string"), F.lit('","pr":"r'), k.cast("string"), F.lit('"}')]
    return F.concat(*parts)


@query("prof_json_defaults", W + """
SELECT user_id AS userID,
  CASE WHEN nation_key % 4 <> 0 THEN nation_key % 5 ELSE 0 END AS marrow,
  CASE WHEN nation_key % 5 <> 0 THEN nation_key ELSE 0 END AS recommend,
  CASE WHEN nation_key % 3 <> 0 THEN nation_key % 2 ELSE 0 END AS vip
FROM users""")
def q_prof_json_defaults(spark, d):
    """PROF7: be -> marrow, us -> recommend, vipAuth -> vip; missing -> "0"."""
    from ..functions import json_int_or_default
    u = standins.users(spark, d)
    j = u.select("user_id", _info_json(u).alias("j"))
    return j.select(F.col("user_id").alias("userID"), json_int_or_default("j", "be").alias("marrow"),
                    json_int_or_default("j", "us").alias("recommend"), json_int_or_default("j", "vipAuth").alias("vip"))


@query("prof_vip_json", W + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, name, CAST(followers_count AS INTEGER) AS followers_count,
  'p' || CAST(nation_key AS VARCHAR) AS introduction,
  CASE WHEN nation_key % 4 <> 0 THEN nation_key % 5 ELSE 0 END AS marrow,
  CASE WHEN nation_key % 5 <> 0 THEN nation_key ELSE 0 END AS recommend,
  CASE WHEN nation_key % 3 <> 0 THEN nation_key % 2 ELSE 0 END AS vip,
  '{schemas.URLS[40004]['blog']}' || CAST(user_id AS VARCHAR) AS home_page,
  '{schemas.URLS[40004]['image']}' || 'r' || CAST(nation_key AS VARCHAR) AS portrait
FROM users""")
def q_prof_vip_json(spark, d):
    """PROF8: VIP info JSON -> fans, name, introduction, home page, portrait
    (image prefix + ``pr``), marrow, recommend, vip."""
    u = standins.users(spark, d)
    return profiles.vip_info(u.select(_info_json(u).alias("j")), "j")


@query("prof_two_islands", W + """
SELECT user_id, name, CAST(followers_count AS BIGINT) AS followers, segment = 'BUILDING' AS verified FROM users""")
def q_prof_two_islands(spark, d):
    """PROF9: two JSON islands on one page (profile header, counters);
    name and verified mark from the first, follower count = 2nd counter cell."""
    u = standins.users(spark, d)
    isl1 = F.to_json(F.struct(F.col("name").alias("name"), (F.col("segment") == "BUILDING").alias("verified")))
    isl2 = F.to_json(F.struct(F.array(F.lit(0).cast("bigint"), F.col("followers_count"), F.lit(7).cast("bigint"))
                              .alias("cells")))
    html = F.concat(F.lit('<script>FM.view({"ns":"pl.header","data":'), isl1, F.lit("})</script><div/>"),
                    F.lit('<script>FM.view({"ns":"pl.counter","data":'), isl2, F.lit("})</script>"))
    h = u.select("user_id", html.alias("h"))
    a = F.regexp_extract("h", r'"ns":"pl\.header","data":(\{.*?\})\}\)', 1)
    b = F.regexp_extract("h", r'"ns":"pl\.counter","data":(\{.*?\})\}\)', 1)
    pa = F.from_json(a, "name STRING, verified BOOLEAN")
    pb = F.from_json(b, "cells ARRAY<BIGINT>")
    return h.select("user_id", pa["name"].alias("name"), F.element_at(pb["cells"], 2).alias("followers"),
                    pa["verified"].alias("verified"))
