"""Reference-shaped inputs derived from the shared driver tables.

The surveyed application reads a raw-page key-value table, a message topic,
per-platform user / VIP / article tables and a marker hash. None of those
exist here, so each is derived, deterministically and over whole tables,
from the driver's Parquet tables. Every derivation has a DuckDB twin in
``SQL`` (same name) so that the oracle queries see identical inputs.

  page_store    pages            table_name '4000'+(page_id%5+1), row_key=url;
                                 empty body landed for page_id%13=0
  messages      pages            one notice per page (+1 re-announcement for
                                 page_id%10=3); %10=7 empty, 8 broken JSON,
                                 9 key missing, 6 page miss, 4 unknown platform
  feed_events   events           one feed page per user, newest first
  feed_markers  feed_events      state as of the previous crawl (max ts - 10
                                 days); users %7=0 never crawled, %11=0 hold a
                                 marker that is no longer on the page
  users         customer         followers = trunc(acctbal), vip = BUILDING
  user_rows     orders           loose per-user rows (several per user)
  articles      pages+documents  catalogue; summary NULL for id%3=0, '' for
                                 id%7=0; page-based urls hit the page store,
                                 document-based ones miss it
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ntz_to_millis

from ..operators.joins import splittable_join
from .tables import table

SQL: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}

FEED_HOST = "https://feed.example"
NEWS_HOST = "https://news.example"
USER_HOST = "https://u.example"
EMPTY_PAGE_IDS = 1_300_000_000   # added to a page's id for its empty neighbour; a multiple of 5, 10 and 13


# --------------------------------------------------------------------------- pages
def page_store(spark: SparkSession, d: str) -> DataFrame:
    """Raw-page table: (table_name, row_key) -> (url, html): every given page,
    and for every 13th one more, empty page beside it."""
    pid = F.col("page_id")
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    empty = pages.where(pid % 13 == 0).select((pid + EMPTY_PAGE_IDS).alias("page_id"),
                                              F.concat("url", F.lit("/empty")).alias("url"), F.lit("").alias("html"))
    return pages.unionByName(empty).select(
        "page_id",
        F.concat(F.lit("4000"), (pid % 5 + 1).cast("string")).alias("table_name"),
        F.col("url").alias("row_key"), "url",
        "html",
        (F.lit(40001) + pid % 5).cast("int").alias("platform_id"))


SQL["page_store"] = f"""
  SELECT page_id, '4000' || CAST(page_id % 5 + 1 AS VARCHAR) AS table_name,
         url AS row_key, url, html, CAST(40001 + page_id % 5 AS INTEGER) AS platform_id
  FROM (SELECT page_id, url, html FROM pages UNION ALL
        SELECT page_id + {EMPTY_PAGE_IDS}, url || '/empty', '' FROM pages WHERE page_id % 13 = 0) t"""


def feed_store(spark: SparkSession, d: str) -> DataFrame:
    """The page store with every page rewritten as its platform's feed page:
    the links of its navigation list are the items, in order; their counters,
    times and flags follow from page id and position (``SQL['feed_items']``).
    Empty pages stay empty."""
    p = page_store(spark, d)
    pid, plat = F.col("page_id"), F.col("platform_id")
    s = pid.cast("string")
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="[^"]*">[^<]*</a>'), 0)

    def text(x):
        return F.regexp_extract(x, r'">([^<]*)</a>', 1)

    def href(x):
        return F.regexp_extract(x, r'href="([^"]*)"', 1)

    def when(i):
        """Minute of the item: falling, with a late one among them."""
        m = F.lit(900) - i * 7 + F.when(i % 4 == 3, F.lit(20)).otherwise(F.lit(0))
        return F.date_format(F.expr("timestamp_ntz'2016-07-14 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), m),
                             "yyyy-MM-dd HH:mm")

    def status(x, i):
        k = (pid + i) % 4
        doc = F.to_json(F.struct(
            (pid * 100 + i).alias("id"), pid.alias("user_id"),
            F.when(k == 1, F.lit("")).when(k > 1, text(x)).alias("title"),
            F.concat(text(x), F.lit(" seen on page "), s).alias("description"), href(x).alias("target"),
            (i + 1).alias("retweet_count"), ((pid + i) % 5).alias("reply_count"),
            F.struct(F.when(i % 2 == 1, F.lit("")).otherwise(F.concat(F.lit("u"), s)).alias("screen_name")).alias("user")),
            {"ignoreNullFields": "false"})
        repost = (F.when((pid + i) % 3 == 0, F.lit(',"retweeted_status":null}'))
                  .when((pid + i) % 3 == 1, F.lit(',"retweeted_status":{"id":1}}')).otherwise(F.lit("}")))
        return F.concat(F.substring(doc, F.lit(1), F.length(doc) - 1), repost)

    statuses = F.concat(
        F.lit("<html><head><title>n"), s, F.when(pid % 7 == 0, F.lit("")).otherwise(F.lit("- 雪球")),
        F.lit("</title></head><body><script>var a=1;</script><script>SNB.data.statuses = {\"statuses\":["),
        F.array_join(F.transform(links, status), ","), F.lit("]};\n  SNB.data.statusType = 1;</script></body></html>"))

    def row(x, i):
        n = F.element_at(F.array(F.lit(""), F.lit('<i class="TuiJian"></i>'), F.lit('<i class="TuiJian"></i>' * 2)), i % 3 + 1)
        return F.concat(
            F.lit('<li><div class="UserBox"><a class="Name" href="http://b.example/u/'), s,
            F.lit('/">n</a><a class="Tit" href="http://b.example/'), s, F.lit("/"), i.cast("string"), F.lit('">'),
            text(x), n, F.lit('</a></div><div class="HandleBox"><span>read 5</span><span>moved '),
            F.when((pid + i) % 6 == 5, F.lit("none")).otherwise(i.cast("string")), F.lit("</span><span>said "),
            (pid % 9).cast("string"), F.lit("</span></div></li>"))

    listed = F.concat(F.lit('<html><div id="Tab1"><div class="TabItem"><ul>'), F.array_join(F.transform(links, row), ""),
                      F.lit("</ul></div></div></html>"))
    tabled = F.concat(F.lit('<html><table class="blu authortab-list">'), F.array_join(F.transform(
        links, lambda x, i: F.concat(F.lit('<tr><td><a href="articleDetails.htm?articleId='), (pid * 100 + i).cast("string"),
                                     F.lit('">'), text(x), F.lit("</a></td></tr>"))), ""), F.lit("</table></html>"))
    record = F.transform(links, lambda x, i: F.struct(
        F.lit("R").alias("actionName"), (pid * 100 + i).cast("string").alias("actionID"), s.alias("objectID"),
        s.alias("userID"), F.concat(F.lit("u"), s).alias("userName"), when(i).alias("actionDate"),
        F.when((pid + i) % 5 == 0, F.lit("0")).otherwise((pid * 100 + i).cast("string")).alias("OtherID"),
        text(x).alias("body")))
    actions = F.to_json(F.struct(record.alias("record")))

    def card(x, i):
        cover = F.when(i == 1, F.lit(" WB_feed_vipcover")).otherwise(F.lit(""))
        mark = F.when((pid + i) % 6 == 5, F.lit("")).otherwise(F.lit("?ref=home&rid=1"))
        head = F.when(i % 2 == 0, F.concat(
            F.lit('<div class="WB_media_wrap clearfix"><div class="WB_feed_spec_info SW_fun"><div class="WB_feed_spec_cont"><h4>'),
            text(x), F.lit("</h4></div></div></div>"))).otherwise(F.lit(""))
        more = F.when((pid + i) % 4 == 3, F.lit('<div class="WB_feed_expand">old</div>')).otherwise(F.lit(""))
        cells = F.concat(*[c for n in (F.lit("a"), F.lit("b"), F.lit("c"), i.cast("string"), F.lit("d"),
                                       F.when(i % 3 == 0, F.lit("评论")).otherwise((pid % 9).cast("string")), F.lit("e"),
                                       (i * 2).cast("string"))
                           for c in (F.lit("<li><span class='pos'><em>"), n, F.lit("</em></span></li>"))])
        return F.concat(
            F.lit('<div class="WB_cardwrap WB_feed_type S_bg2'), cover, F.lit('"><div class="WB_detail"><a class="W_f14 W_fb S_txt1" usercard="id='),
            s, F.lit('&t=1">n'), s, F.lit('</a><div class="WB_from S_txt2"><a title="'), when(i), F.lit('" href="/p/'), s,
            F.lit("/"), i.cast("string"), mark, F.lit('">t</a></div>'), head, more,
            F.lit('</div><div class="WB_feed_handle"><ul>'), cells, F.lit("</ul></div></div>"))

    cards = F.concat(
        F.lit("<html><script>var b=1;</script><script>FM.view("),
        F.to_json(F.struct(F.lit("pl.content.homefeed.index").alias("ns"),
                           F.array_join(F.transform(links, card), "").alias("html"))), F.lit(")</script></html>"))
    html = (F.when(plat == 40001, statuses).when(plat == 40002, listed).when(plat == 40003, tabled)
            .when(plat == 40004, actions).otherwise(cards))
    url = F.when(plat == 40003, F.concat("url", F.lit("&theId="), s)).otherwise(F.col("url"))
    return p.select("page_id", "table_name", url.alias("row_key"), url.alias("url"),
                    F.when(F.col("html") == "", F.lit("")).otherwise(html).alias("html"), "platform_id")


SQL["feed_store"] = """
  SELECT page_id, table_name, CASE WHEN platform_id = 40003 THEN url || '&theId=' || CAST(page_id AS VARCHAR) ELSE url END AS url,
         html AS page, CASE WHEN html = '' THEN '' ELSE 'feed' END AS html, platform_id,
         CASE WHEN platform_id = 40003 THEN url || '&theId=' || CAST(page_id AS VARCHAR) ELSE url END AS row_key
  FROM page_store"""
DEPS["feed_store"] = ["page_store"]

# What each platform's own rules say about the items of those pages, stated
# from the items and not from the page text: order of the walk, key, time,
# counters, whether it is an article, whether the walk goes on.
SQL["feed_items"] = r"""
  SELECT page_id AS p, platform_id, url AS page_url,
    CASE WHEN platform_id <> 40005 THEN i WHEN i = 1 THEN 0 WHEN i = 0 THEN (CASE WHEN n > 1 THEN 1 ELSE 0 END) ELSE i END AS pos,
    i, mins, CASE WHEN platform_id IN (40004, 40005)
      THEN epoch_ms(TIMESTAMP '2016-07-13 16:00:00' + to_minutes(mins)) END AS ts,
    CASE platform_id
      WHEN 40001 THEN CASE (page_id + i) % 4 WHEN 0 THEN substring(txt || ' seen on page ' || s, 1, 30)
        WHEN 1 THEN CASE WHEN i % 2 = 0 THEN 'u' || s || '的观点：' WHEN page_id % 7 = 0 THEN '' ELSE 'n' || s || '的观点：' END
        ELSE txt END
      WHEN 40004 THEN 'u' || s || '的观点: '
      WHEN 40005 THEN CASE WHEN i % 2 = 0 AND plain <> '' THEN plain ELSE 'n' || s || '的观点：' END
      ELSE plain END AS title,
    CASE platform_id
      WHEN 40001 THEN 'https://xueqiu.com' || href
      WHEN 40002 THEN 'http://b.example/' || s || '/' || CAST(i AS VARCHAR)
      WHEN 40003 THEN 'http://moer.jiemian.com/articleDetails.htm?articleId=' || CAST(page_id * 100 + i AS VARCHAR)
      WHEN 40004 THEN 'http://www.taoguba.com.cn/Article/' || s || '/' || CASE WHEN (page_id + i) % 5 = 0 THEN '0' ELSE CAST(page_id * 100 + i AS VARCHAR) END
      ELSE 'http://weibo.com/p/' || s || '/' || CAST(i AS VARCHAR) || CASE WHEN (page_id + i) % 6 = 5 THEN 'type=comment' ELSE '?type=comment' END
    END AS url,
    s AS user_id,
    CASE platform_id WHEN 40001 THEN i + 1 WHEN 40002 THEN TRY_CAST(CASE WHEN (page_id + i) % 6 = 5 THEN NULL ELSE i END AS BIGINT) WHEN 40005 THEN i ELSE 0 END AS reposts,
    CASE platform_id WHEN 40001 THEN (page_id + i) % 5 WHEN 40002 THEN page_id % 9
      WHEN 40005 THEN CASE WHEN i % 3 = 0 THEN 0 ELSE page_id % 9 END ELSE 0 END AS comments,
    CASE platform_id WHEN 40002 THEN i % 3 WHEN 40005 THEN i * 2 ELSE 0 END AS likes,
    CASE platform_id WHEN 40001 THEN (page_id + i) % 3 = 0 WHEN 40002 THEN (page_id + i) % 6 <> 5
      WHEN 40004 THEN (page_id + i) % 5 <> 0 WHEN 40005 THEN (page_id + i) % 4 <> 3 ELSE true END AS keep,
    CASE WHEN platform_id = 40005 THEN (page_id + i) % 4 = 3 OR (page_id + i) % 6 <> 5 ELSE true END AS valid
  FROM (SELECT *, CAST(page_id AS VARCHAR) AS s, trim(replace(txt, '&amp;', '&')) AS plain,
               900 - i * 7 + CASE WHEN i % 4 = 3 THEN 20 ELSE 0 END AS mins FROM (
    SELECT page_id, platform_id, url, len(l) AS n, unnest(range(len(l))) AS i,
      unnest(list_transform(l, lambda x: regexp_extract(x, '">([^<]*)</a>', 1))) AS txt,
      unnest(list_transform(l, lambda x: regexp_extract(x, 'href="([^"]*)"', 1))) AS href
    FROM (SELECT *, regexp_extract_all(page, '<li><a href="[^"]*">[^<]*</a>') AS l FROM feed_store WHERE html <> '') a) b) c"""
DEPS["feed_items"] = ["feed_store"]


def _msg_json(attr, key, pos):
    return F.concat(F.lit('{"attr_id": "'), attr, F.lit('", "key_name": "'), key,
                    F.lit('", "pos_name": "'), pos, F.lit('"}'))


def messages(spark: SparkSession, d: str, store: DataFrame | None = None) -> DataFrame:
    """Inbound page notices ``(msg_seq BIGINT, value STRING)`` for the pages of ``store``."""
    s = (page_store(spark, d) if store is None else store).select("page_id", "table_name", "url")
    k = F.col("page_id") % 10
    t = F.col("table_name")
    attr = F.when(k == 4, F.lit("40000")).otherwise(t)
    pos = F.when(k == 6, F.concat(F.col("url"), F.lit("#gone"))).otherwise(F.col("url"))
    value = (F.when(k == 7, F.lit(""))
             .when(k == 8, F.concat(F.lit('{"attr_id": "'), t, F.lit('", "key_name": ')))
             .when(k == 9, F.concat(F.lit('{"attr_id": "'), t, F.lit('", "key_name": "'), t,
                                    F.lit('"}')))
             .otherwise(_msg_json(attr, t, pos)))
    first = s.select((F.col("page_id") * 2).alias("msg_seq"), value.alias("value"))
    again = s.where(k == 3).select((F.col("page_id") * 2 + 1).alias("msg_seq"),
                                   _msg_json(t, t, F.col("url")).alias("value"))
    return first.unionByName(again)


SQL["messages"] = """
  SELECT page_id * 2 AS msg_seq,
    CASE page_id % 10
      WHEN 7 THEN ''
      WHEN 8 THEN '{"attr_id": "' || table_name || '", "key_name": '
      WHEN 9 THEN '{"attr_id": "' || table_name || '", "key_name": "' || table_name || '"}'
      ELSE '{"attr_id": "' || (CASE WHEN page_id % 10 = 4 THEN '40000' ELSE table_name END)
           || '", "key_name": "' || table_name || '", "pos_name": "'
           || (CASE WHEN page_id % 10 = 6 THEN url || '#gone' ELSE url END) || '"}'
    END AS value
  FROM page_store
  UNION ALL
  SELECT page_id * 2 + 1 AS msg_seq,
    '{"attr_id": "' || table_name || '", "key_name": "' || table_name || '", "pos_name": "'
      || url || '"}' AS value
  FROM page_store WHERE page_id % 10 = 3"""
DEPS["messages"] = ["page_store"]
SQL["feed_messages"] = SQL["messages"].replace("page_store", "feed_store")
DEPS["feed_messages"] = ["feed_store"]


# --------------------------------------------------------------------------- feeds
def feed_events(spark: SparkSession, d: str) -> DataFrame:
    """Ordered feed items: one feed page per user, newest item first
    (order key ``ts DESC, event_id DESC``)."""
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit(FEED_HOST + "/u/"), F.col("user_id").cast("string")).alias("page_url"),
        (F.lit(40001) + F.col("user_id") % 5).cast("int").alias("platform_id"),
        "user_id", "event_id",
        F.concat(F.lit(FEED_HOST + "/p/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.col("event_type"), F.lit("#"), F.get_json_object("props", "$.k")).alias("title"),
        ntz_to_millis("ts").alias("ts_ms"), "ts", "value")


SQL["feed_events"] = f"""
  SELECT '{FEED_HOST}/u/' || CAST(user_id AS VARCHAR) AS page_url,
         CAST(40001 + user_id % 5 AS INTEGER) AS platform_id, user_id, event_id,
         '{FEED_HOST}/p/' || CAST(event_id AS VARCHAR) AS url,
         event_type || '#' || json_extract_string(props, '$.k') AS title,
         epoch_us(ts) // 1000 AS ts_ms, ts, value
  FROM events"""

MARKER_LAG_DAYS = 10


def feed_markers(spark: SparkSession, d: str) -> DataFrame:
    """Marker per feed page as of the previous crawl: the newest item seen
    then (title, url, ts). One aggregation; no per-page window."""
    f = feed_events(spark, d)
    crawl_ts = f.select(F.max("ts") - F.expr(f"INTERVAL {MARKER_LAG_DAYS} DAYS")).scalar()
    order = F.struct("ts", "event_id")
    m = (f.where(F.col("ts") <= crawl_ts)
         .groupBy("page_url", "user_id")
         .agg(F.max_by("title", order).alias("last_title"),
              F.max_by("url", order).alias("last_url"),
              F.max_by("ts_ms", order).alias("last_ts_ms")))
    gone = F.col("user_id") % 11 == 0
    return m.where(F.col("user_id") % 7 != 0).select(
        "page_url", "user_id",
        F.when(gone, F.lit("gone#0")).otherwise(F.col("last_title")).alias("last_title"),
        F.when(gone, F.lit(FEED_HOST + "/p/-1")).otherwise(F.col("last_url")).alias("last_url"),
        "last_ts_ms")


SQL["feed_markers"] = f"""
  SELECT page_url, user_id,
         CASE WHEN user_id % 11 = 0 THEN 'gone#0' ELSE title END AS last_title,
         CASE WHEN user_id % 11 = 0 THEN '{FEED_HOST}/p/-1' ELSE url END AS last_url,
         ts_ms AS last_ts_ms
  FROM (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY ts DESC, event_id DESC) AS rn
        FROM feed_events
        WHERE ts <= (SELECT max(ts) - INTERVAL {MARKER_LAG_DAYS} DAYS FROM feed_events)) s
  WHERE rn = 1 AND user_id % 7 <> 0"""
DEPS["feed_markers"] = ["feed_events"]


# --------------------------------------------------------------------------- users
def users(spark: SparkSession, d: str) -> DataFrame:
    """User / VIP profile rows."""
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("bigint").alias("followers_count"),
        (F.col("c_mktsegment") == "BUILDING").alias("vip"),
        (F.lit(40001) + F.col("c_nationkey") % 5).cast("int").alias("platform_id"),
        F.concat(F.lit(USER_HOST + "/"), F.col("c_custkey").cast("string")).alias("home_page"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"))


SQL["users"] = f"""
  SELECT c_custkey AS user_id, c_name AS name,
         CAST(trunc(c_acctbal) AS BIGINT) AS followers_count,
         c_mktsegment = 'BUILDING' AS vip,
         CAST(40001 + c_nationkey % 5 AS INTEGER) AS platform_id,
         '{USER_HOST}/' || CAST(c_custkey AS VARCHAR) AS home_page,
         c_nationkey AS nation_key, c_mktsegment AS segment
  FROM customer"""


def user_rows(spark: SparkSession, d: str) -> DataFrame:
    """Loose per-user rows (several per user, as the unkeyed user tables)."""
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("row_id"),
        (F.col("o_totalprice") / 100).cast("bigint").alias("followers_count"),
        (F.col("o_orderpriority") == "1-URGENT").alias("vip"),
        F.month("o_orderdate").alias("recommend"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("marrow"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("vip_level"))


SQL["user_rows"] = """
  SELECT o_custkey AS user_id, o_orderkey AS row_id,
         CAST(trunc(o_totalprice / 100) AS BIGINT) AS followers_count,
         o_orderpriority = '1-URGENT' AS vip,
         CAST(month(o_orderdate) AS INTEGER) AS recommend,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS marrow,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS vip_level
  FROM orders"""


# --------------------------------------------------------------------------- articles
def articles(spark: SparkSession, d: str) -> DataFrame:
    """Article catalogue ``(platform_id, user_id, title, url, ts, summary)``.
    ts is an epoch-second stand-in, unique over the union."""
    p = table(spark, d, "pages")
    pid = F.col("page_id")
    from_pages = p.select(
        (F.lit(40001) + pid % 5).cast("int").alias("platform_id"),
        F.regexp_extract("url", r"/([0-9]+)", 1).alias("user_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        "url",
        (F.lit(1460000000) + pid * 2 + 1).alias("ts"),
        F.when(pid % 3 == 0, F.lit(None).cast("string")).when(pid % 7 == 0, F.lit(""))
         .otherwise(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)).alias("summary"))
    doc = table(spark, d, "documents")
    did = F.col("doc_id")
    from_docs = doc.select(
        (F.lit(40001) + did % 5).cast("int").alias("platform_id"),
        F.col("source").alias("user_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit(NEWS_HOST + "/"), F.col("lang"), F.lit("/"), did.cast("string")).alias("url"),
        (F.lit(1460000000) + did * 2).alias("ts"),
        F.when(did % 3 == 0, F.lit(None).cast("string")).when(did % 7 == 0, F.lit(""))
         .otherwise(F.col("text")).alias("summary"))
    return from_pages.unionByName(from_docs)


SQL["articles"] = f"""
  SELECT CAST(40001 + page_id % 5 AS INTEGER) AS platform_id,
         regexp_extract(url, '/([0-9]+)', 1) AS user_id,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         url, 1460000000 + page_id * 2 + 1 AS ts,
         CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 7 = 0 THEN ''
              ELSE regexp_extract(html, '<h1>([^<]*)</h1>', 1) END AS summary
  FROM pages
  UNION ALL
  SELECT CAST(40001 + doc_id % 5 AS INTEGER) AS platform_id, source AS user_id,
         split_part(text, chr(10), 1) AS title,
         '{NEWS_HOST}/' || lang || '/' || CAST(doc_id AS VARCHAR) AS url,
         1460000000 + doc_id * 2 AS ts,
         CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN ''
              ELSE text END AS summary
  FROM documents"""


def with_ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named stand-ins and their
    dependencies, in dependency order (DuckDB side of the oracle)."""
    order: list[str] = []

    def visit(n):
        for dep in DEPS.get(n, []):
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order)


# --------------------------------------------------------------------------- profile pages
def profile_index(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, page_id): a stored page is a user's home / list page when
    the first number in its url path is the user id; the lowest page id
    wins. Only keys cross the shuffle here, never html."""
    s = page_store(spark, d).select(
        F.regexp_extract("url", r"/([0-9]+)", 1).try_cast("bigint").alias("user_id"), "page_id")
    return s.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.min("page_id").alias("page_id"))


SQL["profile_index"] = """
  SELECT user_id, min(page_id) AS page_id FROM (
    SELECT TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS user_id, page_id FROM page_store) t
  WHERE user_id IS NOT NULL GROUP BY user_id"""
DEPS["profile_index"] = ["page_store"]


def profile_pages(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, page_url, page_html): the stored page of each user."""
    store = page_store(spark, d).select("page_id", F.col("url").alias("page_url"), F.col("html").alias("page_html"))
    return profile_index(spark, d).join(store, "page_id").select("user_id", "page_url", "page_html")


def profile_lookup(spark: SparkSession, d: str, requests: DataFrame) -> DataFrame:
    """Requests + (page_url, page_html) of the user's stored page (NULL on
    miss)."""
    return splittable_join(requests, profile_pages(spark, d), ["user_id"], "left")
