"""Proof queries: message handling and page sources (MSG, SRC)."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from .. import schemas
from ..operators import lookup, messages
from ..operators import extract
from ..operators.charset import decoded
from ..sources import standins
from ..sources.site_pages import site_pages
from ..sources.tables import table
from ..session import scratch_path
from .oracle_common import PARSED_SQL, PLATFORMS_SQL, article_task_sql, crawl_task_sql
from .registry import query

W = standins.with_ctes("page_store", "messages")
W_ROUTED = W + f""",
platforms AS ({PLATFORMS_SQL}),
parsed AS ({PARSED_SQL}),
good AS (SELECT *, CAST(attr_id AS INTEGER) AS platform_id FROM parsed WHERE reason IS NULL),
routed AS (SELECT g.*, p.platform_name, p.marker_kind FROM good g JOIN platforms p USING (platform_id)),
looked AS (SELECT r.msg_seq, r.platform_id, r.key_name, r.pos_name,
                  CASE WHEN s.url IS NOT NULL AND s.html IS NOT NULL THEN s.url END AS page_url,
                  CASE WHEN s.url IS NOT NULL AND s.html IS NOT NULL THEN s.html END AS page_html
           FROM routed r LEFT JOIN page_store s ON s.table_name = r.key_name AND s.row_key = r.pos_name)"""


def _routed(spark, d):
    good, _ = messages.parse(standins.messages(spark, d))
    routed, _ = messages.route(good, schemas.platforms(spark))
    return routed


def _looked(spark, d):
    return lookup.lookup(_routed(spark, d), standins.page_store(spark, d))


@query("msg_nonempty", W + "\nSELECT msg_seq, value FROM messages WHERE length(value) > 0")
def q_msg_nonempty(spark, d):
    """MSG1."""
    return messages.nonempty(standins.messages(spark, d))


@query("msg_parse", W + f""", parsed AS ({PARSED_SQL})
SELECT msg_seq, CAST(attr_id AS INTEGER) AS platform_id, attr_id, key_name, pos_name
FROM parsed WHERE reason IS NULL""")
def q_msg_parse(spark, d):
    """MSG2, good branch."""
    good, _ = messages.parse(standins.messages(spark, d))
    return good.select("msg_seq", "platform_id", "attr_id", "key_name", "pos_name")


@query("msg_rejects", W + f""", platforms AS ({PLATFORMS_SQL}), parsed AS ({PARSED_SQL})
SELECT msg_seq, reason FROM parsed WHERE reason IS NOT NULL
UNION ALL
SELECT msg_seq, 'unknown_platform' AS reason FROM parsed
WHERE reason IS NULL AND CAST(attr_id AS INTEGER) NOT IN (SELECT platform_id FROM platforms)""")
def q_msg_rejects(spark, d):
    """MSG2 + MSG3 reject branches with reasons."""
    good, rejects = messages.parse(standins.messages(spark, d))
    _, unknown = messages.route(good, schemas.platforms(spark))
    return rejects.select("msg_seq", "reason").unionByName(unknown.select("msg_seq", "reason"))


@query("msg_route_counts", W + f""", platforms AS ({PLATFORMS_SQL}), parsed AS ({PARSED_SQL})
SELECT route, count(*) AS n FROM (
  SELECT CASE WHEN p.platform_name IS NOT NULL THEN p.platform_name
              WHEN x.reason IS NOT NULL THEN 'reject:' || x.reason
              ELSE 'reject:unknown_platform' END AS route
  FROM parsed x LEFT JOIN platforms p ON x.reason IS NULL AND CAST(x.attr_id AS INTEGER) = p.platform_id) t
GROUP BY route""")
def q_msg_route_counts(spark, d):
    """MSG3: notices per handler; unmatched and bad notices per reason."""
    c = messages.classify(standins.messages(spark, d))
    p = F.broadcast(schemas.platforms(spark).withColumnRenamed("platform_id", "_pid"))
    j = c.join(p, F.col("reason").isNull() & (F.col("platform_id") == F.col("_pid")), "left")
    route = (F.when(F.col("platform_name").isNotNull(), F.col("platform_name"))
             .when(F.col("reason").isNotNull(), F.concat(F.lit("reject:"), F.col("reason")))
             .otherwise(F.lit("reject:unknown_platform")))
    return j.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("src_page_lookup", W_ROUTED + """
SELECT msg_seq, page_url, CAST(length(page_html) AS INTEGER) AS html_len, md5(page_html) AS html_md5 FROM looked""")
def q_src_page_lookup(spark, d):
    """SRC2: (table, row key) -> (url, html); NULL on miss."""
    return _looked(spark, d).select("msg_seq", "page_url", F.length("page_html").alias("html_len"),
                                     F.md5("page_html").alias("html_md5"))


@query("src_content_lookup", W_ROUTED + """
SELECT r.msg_seq, CAST(length(s.html) AS INTEGER) AS content_len, md5(s.html) AS content_md5
FROM routed r LEFT JOIN page_store s ON s.table_name = r.key_name AND s.row_key = r.pos_name""")
def q_src_content_lookup(spark, d):
    """SRC3: content cell only."""
    lk = lookup.lookup_content(_routed(spark, d), standins.page_store(spark, d))
    return lk.select("msg_seq", F.length("page_html").alias("content_len"), F.md5("page_html").alias("content_md5"))


@query("msg_page_miss", W_ROUTED + """
SELECT msg_seq, key_name, pos_name FROM looked WHERE page_url IS NULL""")
def q_msg_page_miss(spark, d):
    """MSG4: lookups that found nothing are dropped from parsing (and kept here)."""
    lk = _looked(spark, d)
    return lk.where(F.col("page_url").isNull()).select("msg_seq", "key_name", "pos_name")


@query("msg_hit_miss", W_ROUTED + """
SELECT msg_seq, platform_id,
       (page_html IS NULL) AS miss_null,
       (page_html IS NULL OR page_url IS NULL OR page_html = '' OR page_url = '') AS miss_null_or_empty,
       CASE WHEN page_html IS NULL OR page_url IS NULL OR page_html = '' OR page_url = ''
            THEN to_json({'id': '', 'attrid': CAST(platform_id AS VARCHAR), 'cookie': '', 'referer': '',
                          'url': pos_name, 'result': '0'})::VARCHAR END AS task
FROM looked""")
def q_msg_hit_miss(spark, d):
    """MSG7: one left join, both miss rules; a miss becomes a crawl task."""
    lk = _looked(spark, d)
    miss = lookup.is_miss(lookup.MISS_NULL_OR_EMPTY)
    return lk.select("msg_seq", "platform_id",
                     lookup.is_miss(lookup.MISS_NULL, url=None).alias("miss_null"),
                     miss.alias("miss_null_or_empty"),
                     F.when(miss, messages.crawl_task("platform_id", "pos_name", schemas.RESULT_CRAWL))
                     .alias("task"))


W_ART = standins.with_ctes("articles")


@query("msg_article_task_json", W_ART + f"""
SELECT url, {article_task_sql('platform_id', 'url', 'CASE WHEN platform_id = 40005 THEN 1 ELSE 0 END')} AS task
FROM articles""")
def q_msg_article_task_json(spark, d):
    """MSG5: article task per catalogue row (islogin 1 only for 40005)."""
    a = standins.articles(spark, d)
    islogin = F.when(F.col("platform_id") == 40005, 1).otherwise(0)
    return a.select("url", messages.article_task("platform_id", "url", islogin).alias("task"))


@query("msg_crawl_task_json", W_ART + f"""
SELECT url, {crawl_task_sql('platform_id', 'url', "CASE WHEN summary IS NULL THEN 0 ELSE 2 END")} AS task
FROM articles""")
def q_msg_crawl_task_json(spark, d):
    """MSG6: crawl task per catalogue row; result 0 (crawl) or 2 (recrawl)."""
    a = standins.articles(spark, d)
    res = F.when(F.col("summary").isNull(), 0).otherwise(2)
    return a.select("url", messages.crawl_task("platform_id", "url", res).alias("task"))


U = schemas.URLS
W_USERS = standins.with_ctes("users")


def _lit(s):
    return "'" + s.replace("'", "''") + "'"


@query("msg_build_urls", W_USERS + f"""
SELECT user_id,
  {_lit(U[40001]['friend_list'])} || CAST(user_id AS VARCHAR) AS friend_list_url,
  {_lit(U[40004]['user_info'])} || CAST(user_id AS VARCHAR) AS info_url,
  {_lit(U[40004]['blog'])} || CAST(user_id AS VARCHAR) AS blog_url,
  {_lit(U[40003]['author'])} || CAST(user_id AS VARCHAR) AS author_url,
  {_lit(U[40002]['article_list'])} || CAST(user_id AS VARCHAR) || '/1' AS list_url,
  {_lit(U[40005]['home_page'])} || CAST(user_id AS VARCHAR) AS home_url,
  'http://blog.cnfol.com/' || CAST(user_id AS VARCHAR) || '/myfocus/friend' AS focus_url,
  'http://blog.cnfol.com/' || CAST(user_id AS VARCHAR) AS blog_home_url,
  'http://www.taoguba.com.cn/Article/' || CAST(user_id AS VARCHAR) AS article_url,
  'http://xueqiu.com/about/mobile-xueqiu/' || CAST(user_id AS VARCHAR) AS status_url
FROM users""")
def q_msg_build_urls(spark, d):
    """MSG8: prefix + id task urls."""
    u = standins.users(spark, d)
    return u.select(
        "user_id",
        messages.build_url(U[40001]["friend_list"], "user_id").alias("friend_list_url"),
        messages.build_url(U[40004]["user_info"], "user_id").alias("info_url"),
        messages.build_url(U[40004]["blog"], "user_id").alias("blog_url"),
        messages.build_url(U[40003]["author"], "user_id").alias("author_url"),
        messages.build_url(U[40002]["article_list"], "user_id", "/1").alias("list_url"),
        messages.build_url(U[40005]["home_page"], "user_id").alias("home_url"),
        messages.build_url(U[40002]["home_page"], "user_id", schemas.FOCUS_LIST).alias("focus_url"),
        messages.build_url(U[40002]["home_page"], "user_id").alias("blog_home_url"),
        messages.build_url(U[40004]["article"], "user_id").alias("article_url"),
        messages.build_url(U[40001]["status"], "user_id").alias("status_url"))


@query("msg_fanout_two", standins.with_ctes("user_rows") + f"""
SELECT DISTINCT user_id, kind, url FROM (
  SELECT user_id, 'friends' AS kind, {_lit(U[40004]['friend_list'])} || CAST(user_id AS VARCHAR) AS url FROM user_rows
  UNION ALL
  SELECT user_id, 'info' AS kind, {_lit(U[40004]['user_info'])} || CAST(user_id AS VARCHAR) AS url FROM user_rows) t""")
def q_msg_fanout_two(spark, d):
    """MSG9 / JOB14: every known user yields a friend-list and an info task
    (users known several times are emitted once)."""
    u = standins.user_rows(spark, d).select("user_id").distinct()
    return messages.fanout(u, {
        "friends": messages.build_url(U[40004]["friend_list"], "user_id"),
        "info": messages.build_url(U[40004]["user_info"], "user_id")})


@query("msg_page_range", W_USERS + f"""
SELECT user_id, page_no, {_lit(U[40002]['article_list'])} || CAST(user_id AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS url
FROM (SELECT user_id, unnest(range(2, CAST(abs(followers_count) % 7 AS INTEGER) + 1)) AS page_no FROM users) t""")
def q_msg_page_range(spark, d):
    """MSG10: blog pages 2..N per user from a page-count label (here
    |followers| % 7); empty when N < 2."""
    u = standins.users(spark, d).select(
        "user_id", (F.abs("followers_count") % 7).cast("int").alias("n_pages"))
    r = messages.page_range(u, F.lit(2), F.col("n_pages"))
    return r.select("user_id", F.col("page_no").cast("bigint").alias("page_no"),
                    F.concat(F.lit(U[40002]["article_list"]), F.col("user_id").cast("string"),
                             F.lit("/"), F.col("page_no").cast("string")).alias("url"))


@query("msg_list_pages", W_USERS + f""",
p AS (SELECT page_no, {_lit(U[40003]['list_page'])} || CAST(page_no AS VARCHAR) AS url
      FROM (SELECT unnest(range(1, {schemas.LIST_PAGES_40003} + 1)) AS page_no) t)
SELECT page_no, p.url, u.user_id IS NOT NULL AS hit, CAST(length(u.name) + length('<html><p></p></html>') AS INTEGER) AS html_len,
  CASE WHEN u.user_id IS NULL THEN {{crawl_task_sql('40003', 'p.url', '0')}} END AS task
FROM p LEFT JOIN users u ON u.user_id = p.page_no AND u.user_id % 9 = 0""".replace("{crawl_task_sql('40003', 'p.url', '0')}", crawl_task_sql('40003', 'p.url', '0')))
def q_msg_list_pages(spark, d):
    """MSG10: the generated list pages 1..2024 are looked up; a missing one gives its
    crawl task."""
    lk = lookup.lookup_by_url(messages.list_page_requests(spark), site_pages(spark, d), "url", ("url", "html"))
    miss = lookup.is_miss(lookup.MISS_NULL_OR_EMPTY)
    return lk.select("page_no", "url", (~miss).alias("hit"), F.length("page_html").alias("html_len"),
                     F.when(miss, messages.crawl_task(F.lit(40003), "url", schemas.RESULT_CRAWL)).alias("task"))


@query("src_script_payload", """
SELECT page_id,
  CAST(regexp_extract(list_filter(regexp_extract_all(html, '<script>(.*?)</script>', 1),
                                  lambda s: contains(s, 'track('))[-1], 'track\\(([0-9]+)\\)', 1) AS INTEGER) AS track_no
FROM pages""")
def q_src_script_payload(spark, d):
    """SRC8: last script holding a marker -> payload cut -> value."""
    p = table(spark, d, "pages")
    scripts = F.regexp_extract_all("html", F.lit(extract.SCRIPT), 1)
    last = F.element_at(F.filter(scripts, lambda s: s.contains("track(")), -1)
    return p.select("page_id", F.regexp_extract(last, r"track\(([0-9]+)\)", 1).try_cast("int")
                    .alias("track_no"))


@query("src_marker_json", """
SELECT page_id,
  split_part(split_part(html, '<h1>', 2), '</h1>', 1) AS headline,
  CASE WHEN strpos(html, '<footer>') > 0
       THEN split_part(split_part(html, '<footer>', 2), '</footer>', 1) END AS footer
FROM pages""")
def q_src_marker_json(spark, d):
    """SRC10: text between two literal markers (substring_index, no regex)."""
    p = table(spark, d, "pages")
    between = lambda a, b: F.substring_index(F.substring_index("html", a, -1), b, 1)
    return p.select("page_id",
                    F.when(F.instr("html", "<h1>") > 0, between("<h1>", "</h1>"))
                    .otherwise(F.lit("")).alias("headline"),
                    F.when(F.instr("html", "<footer>") > 0, between("<footer>", "</footer>"))
                    .alias("footer"))


@query("src_json_island", """
SELECT event_id, user_id AS uid, event_type AS kind, '<em>' || CAST(value AS VARCHAR) || '</em> f({1})' AS html FROM events""")
def q_src_json_island(spark, d):
    """SRC9: JSON island in a script, cut at the script's end (its payload holds
    the closing marks too), parsed. The oracle states what was put in."""
    e = table(spark, d, "events")
    doc = F.to_json(F.struct(F.lit("pl.content").alias("ns"), F.col("user_id").alias("uid"), F.col("event_type").alias("kind"),
                             F.concat(F.lit("<em>"), F.col("value").cast("string"), F.lit("</em> f({1})")).alias("html")))
    html = F.concat(F.lit("<script>var a=1;</script><script>FM.view("), doc, F.lit(")</script><script>b({2})</script>"))
    parsed = F.from_json(extract.island(html, "FM.view"), "uid BIGINT, kind STRING, html STRING")
    return e.select("event_id", parsed["uid"].alias("uid"), parsed["kind"].alias("kind"), parsed["html"].alias("html"))


@query("src_fans_count", W_USERS + """
SELECT user_id, CAST(json_extract_string('{"ok":1,"count":' || CAST(followers_count AS VARCHAR) || '}', '$.count') AS INTEGER) AS fans
FROM users""")
def q_src_fans_count(spark, d):
    """SRC11: landed count responses -> int."""
    u = standins.users(spark, d)
    body = F.concat(F.lit('{"ok":1,"count":'), F.col("followers_count").cast("string"), F.lit("}"))
    return u.select("user_id", F.get_json_object(body, "$.count").try_cast("int").alias("fans"))


@query("src_decode", """
SELECT page_id,
  CAST(CASE WHEN page_id % 2 = 0 THEN length(html) ELSE length(html) + 2 END AS INTEGER) AS decoded_len,
  true AS same
FROM pages""")
def q_src_decode(spark, d):
    """SRC4: stored bytes decoded by a UTF-8 / GBK cascade. The oracle states
    the expected text (DuckDB has no GBK codec): even pages decode to the
    page, odd pages to the 2-character prefix plus the masked page, and the
    decoded text always equals what was stored."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")   # GBK codec
    p = table(spark, d, "pages")
    # odd pages land as GBK bytes: a CJK prefix plus the page with non-ASCII
    # characters masked (GBK cannot encode every Latin letter).
    gbk_text = F.concat(F.lit("中文"), F.regexp_replace("html", r"[^\x00-\x7F]", "?"))
    text = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(gbk_text)
    enc = F.when(F.col("page_id") % 2 == 0, F.encode(text, "UTF-8")).otherwise(F.encode(text, "GBK"))
    dec = lookup.decode_content(enc)
    return p.select("page_id", F.length(dec).alias("decoded_len"), (dec == text).alias("same"))


#: Letters of the documents and a character of the GBK and Big5 charsets for each.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâçîïôûùœáíóúñ"
HAN = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽雲騰致雨露結為霜金生麗水玉出崑岡劍號巨闕"[:len(LETTERS)]


@query("src_detect", f"""
SELECT doc_id, CASE WHEN charset = 'cp1252' AND NOT regexp_matches(text, '[^\\x00-\\x7F]') THEN 'utf-8' ELSE charset END AS charset,
  length(text) AS n_chars, md5(text) AS text_md5 FROM (
  SELECT doc_id, ['utf-8', 'gbk', 'big5', 'cp1252'][CAST(doc_id % 4 AS INTEGER) + 1] AS charset,
    CASE WHEN doc_id % 4 IN (1, 2) THEN translate(lower(text), '{LETTERS}', '{HAN}') ELSE text END AS text FROM documents) t""")
def q_src_detect(spark, d):
    """SRC4: whole texts landed in four charsets (by id), two of them written in Han
    characters, are read back by the detector: charset, length and digest of the text (one
    without accents is the same bytes in UTF-8 and Windows-1252)."""
    docs = table(spark, d, "documents")
    k = F.col("doc_id") % 4
    text = F.when(k.isin(1, 2), F.translate(F.lower("text"), LETTERS, HAN)).otherwise(F.col("text"))
    name = F.element_at(F.array(*[F.lit(c) for c in ("utf-8", "gbk", "big5", "cp1252")]), (k + 1).cast("int"))
    landed = docs.select("doc_id", _encoded(text, name).alias("raw"))
    found = landed.select("doc_id", decoded(F.col("raw")).alias("f"))
    return found.select("doc_id", "f.charset", F.length("f.text").cast("bigint").alias("n_chars"), F.md5("f.text").alias("text_md5"))


def _encoded(text, charset):
    """The bytes of a text in a charset (how the pages were landed)."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array, names: pa.Array) -> pa.Array:
        return pa.array([t.as_py().encode(n.as_py()) if t.is_valid else None for t, n in zip(texts, names)], pa.binary())

    return run(text, charset)


@query("src_seed_list", W_USERS + """
SELECT DISTINCT home_page AS url FROM users WHERE vip OR followers_count > 500""")
def q_src_seed_list(spark, d):
    """SRC6 + REL12: a landed seed file (one url per line, repeats included:
    VIPs with many followers appear twice) read as text and de-duplicated."""
    u = standins.users(spark, d)
    lines = (u.where(F.col("vip")).select(F.col("home_page").alias("value"))
             .unionByName(u.where(F.col("followers_count") > 500).select(F.col("home_page").alias("value"))))
    path = scratch_path(spark, "seeds")
    lines.write.mode("overwrite").text(path)
    from ..sources.tables import seed_lines
    return seed_lines(spark, path)
