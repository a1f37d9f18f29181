"""Extractors on hand-made platform pages (shapes from FIXTURES.md; the
texts are our own)."""
import json

from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import feeds, html_walk
from feedlake.plans.q_feeds2 import LABEL_COMMENT, LABEL_FORWARD, LABEL_LIKE, SHIFT_MARK, counter


def _action_page():
    recs = []
    for i in range(15):
        name = "T" if i == 7 else "R"
        body = f"note {i} about the market"
        if i in (1, 4, 9, 12):
            body += "[quote]an older remark"
        recs.append({"actionName": name, "actionID": str(900 - i), "objectName": "topic",
                     "objectID": "77", "userID": "4242", "userName": "trader",
                     "actionDate": f"2016-07-14 10:{59 - i:02d}", "images": [], "flashs": "",
                     "voices": [], "OtherID": "0" if name == "T" else str(5000 + i), "portrait": "",
                     "body": body})
    return json.dumps({"sfNum": 15, "size": 15, "perPageNum": 15, "pageNo": 1, "actionID": 0, "record": recs},
                      ensure_ascii=False)


def test_action_page(spark):
    pages = spark.createDataFrame([("http://a/p1", _action_page())], "page_url string, doc string")
    rows = feeds.action_items(pages, ["page_url"]).orderBy("pos").collect()
    assert len(rows) == 14                              # the T record (OtherID 0) is dropped
    assert all("[quote]" not in r.body for r in rows)
    assert sum(1 for r in rows if r.body.endswith("market")) == 14
    assert rows[0].title == "trader" + schemas.ACTION_TITLE_SUFFIX
    assert rows[0].url == schemas.URLS[40004]["article"] + "77/5000"
    # Asia/Shanghai wall clock
    assert rows[0].ts_ms == 1468465140000


def _status_doc():
    return json.dumps({"statuses": [
        {"id": 3, "user_id": 11, "title": "", "description": "<b>new</b> post text", "target": "/11/3",
         "retweet_count": 2, "reply_count": 1, "created_at": 1468463935000, "retweeted_status": None,
         "user": {"screen_name": "alice"}},
        {"id": 2, "user_id": 11, "title": "a repost", "description": "x", "target": "/11/2",
         "retweet_count": 0, "reply_count": 0, "created_at": 1468463900000, "retweeted_status": {"id": 1},
         "user": {"screen_name": "alice"}},
        {"id": 1, "user_id": 11, "title": None, "description": "d" * 40, "target": "/11/1",
         "created_at": 1468463800000, "retweeted_status": None, "user": {"screen_name": ""}},
        {"id": 0, "user_id": 11, "title": "no key", "description": "x", "target": "/11/0",
         "created_at": 1468463700000, "user": {"screen_name": ""}},
    ]})


def test_status_page(spark):
    pages = spark.createDataFrame([("http://s/11", "owner", _status_doc())], "page_url string, owner string, doc string")
    s = feeds.status_items(pages, ["page_url", "owner"])
    rows = {r.id: r for r in s.select(
        "id", "is_original", "retweet", "reply",
        feeds.title_fallback(F.col("title"), F.col("screen_name"), F.col("owner"), F.col("description")).alias("t"),
        feeds.short_headline(F.col("title"), F.col("description")).alias("h")).collect()}
    assert [i for i, r in sorted(rows.items()) if r.is_original] == [1, 3]   # null present -> original
    assert rows[3].t == "alice" + schemas.TITLE_SUFFIX
    assert rows[1].t == "d" * 30                                             # NULL title -> headline
    assert rows[0].t == "no key"
    assert rows[1].retweet is None and rows[3].retweet == 2                  # missing counter stays NULL


def test_counters(spark):
    df = spark.createDataFrame([
        (["", "", "", "12", "", "3", "", "7"],),
        (["", "", "", LABEL_FORWARD, "", SHIFT_MARK, "4", LABEL_LIKE],),
        (["", "", ""],),
        (["", "", "", "5", "", LABEL_COMMENT + "x"],),
    ], "ems array<string>")
    rows = df.select(counter(F.col("ems"), 3, LABEL_FORWARD).alias("f"),
                     counter(F.col("ems"), 5, LABEL_COMMENT, shift_idx=6).alias("c"),
                     counter(F.col("ems"), 7, LABEL_LIKE).alias("l")).collect()
    assert [(r.f, r.c, r.l) for r in rows] == [(12, 3, 7), (0, 4, 0), (0, 0, 0), (5, 0, 0)]


def test_html_walker_nesting(spark):
    html = ('<div class="card x"><p>one <b>bold</b></p><div>inner</div> tail</div>'
            '<div class="card"><img src="a.png"><p>two</p>'  # unclosed at the end
            )
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = html_walk.html_blocks(df, [("card", "div", "card", None), ("img", "img", None, "src")]).collect()
    cards = sorted((r.pos, r.text) for r in rows if r.block == "card")
    assert cards == [(0, "one boldinner tail"), (1, "two")]
    assert [r.attr for r in rows if r.block == "img"] == ["a.png"]


def test_profile_json_rules(spark):
    from feedlake.functions import json_get_or_default, json_int_or_default
    docs = spark.createDataFrame([
        ('{"userID":"7","be":"3","us":"9","vipAuth":"1"}',),
        ('{"userID":"8"}',),                       # keys missing -> "0"
        ('{"userID":"9","be":null,"us":"x"}',),    # JSON null stays NULL, bad int -> NULL
    ], "j string")
    rows = docs.select(json_get_or_default("j", "userID").alias("id"),
                       json_int_or_default("j", "be").alias("marrow"),
                       json_int_or_default("j", "us").alias("recommend"),
                       json_int_or_default("j", "vipAuth").alias("vip")).collect()
    assert [(r.id, r.marrow, r.recommend, r.vip) for r in rows] == [
        ("7", 3, 9, 1), ("8", 0, 0, 0), ("9", None, None, 0)]


def test_user_list_page(spark):
    doc = json.dumps({"users": [
        {"id": 1001, "followers_count": 150, "screen_name": "a", "description": None,
         "profile_image_url": "x1.png,x2.png"},
        {"id": 1002, "followers_count": 90, "screen_name": "b", "description": "hi",
         "profile_image_url": "y.png"}]})
    p = spark.createDataFrame([(doc,)], "doc string").select(F.from_json("doc", schemas.USER_LIST_PAGE).alias("p"))
    rows = p.select(F.explode("p.users").alias("u")).select(
        F.col("u.id").cast("string").alias("id"), F.coalesce("u.description", F.lit("")).alias("intro"),
        F.concat(F.lit(schemas.URLS[40001]["image"]), F.split("u.profile_image_url", ",").getItem(0)).alias("img"),
        (F.col("u.followers_count") > schemas.FOLLOWER_GATE_EXPAND).alias("expand")).collect()
    assert [(r.id, r.intro, r.img, r.expand) for r in rows] == [
        ("1001", "", schemas.URLS[40001]["image"] + "x1.png", True),
        ("1002", "hi", schemas.URLS[40001]["image"] + "y.png", False)]


def test_permalink_take_while(spark):
    from feedlake.operators import increments as inc
    from feedlake.plans.q_feeds2 import PERMALINK_MARK
    cards = spark.createDataFrame([
        ("p", 0, "http://w/1/10" + PERMALINK_MARK + "5"),
        ("p", 1, "http://w/1/11" + PERMALINK_MARK + "6"),
        ("p", 2, "http://w/1/12"),                       # no permalink: the walk stops here
        ("p", 3, "http://w/1/13" + PERMALINK_MARK + "7"),
    ], "page string, pos int, link string")
    kept = inc.take_while(cards, "page", F.col("pos"), ~F.col("link").contains(PERMALINK_MARK))
    links = [r.p for r in kept.orderBy("pos").select(
        F.concat(F.substring_index("link", "ref=home", 1), F.lit("type=comment")).alias("p")).collect()]
    assert links == ["http://w/1/10?type=comment", "http://w/1/11?type=comment"]


def test_status_page_from_script(spark):
    """SRC8 + SRC10 + FEED3 on a hand-made page: the statuses JSON sits in the
    last script holding the marker, between two literal markers."""
    from feedlake.operators import extract
    statuses = json.dumps([
        {"id": 5, "user_id": 21, "title": "t5", "description": "d", "target": "/21/5", "retweet_count": 1,
         "reply_count": 0, "created_at": 1468463935000, "retweeted_status": None, "user": {"screen_name": "z"}},
        {"id": 4, "user_id": 21, "title": "t4", "description": "d", "target": "/21/4",
         "retweeted_status": {"id": 1}, "user": {"screen_name": "z"}}])
    html = ("<html><script>var SNB = {};</script><script>SNB.data.statuses = [];\n  SNB.data.statusType = 0;</script>"
            "<script>SNB.data.statuses = " + statuses + ";\n  SNB.data.statusType = 1;</script></html>")
    pages = spark.createDataFrame([("http://s/21", "owner", html)], "page_url string, owner string, html string")
    docs = pages.select("page_url", "owner", extract.status_doc("html").alias("doc"))
    rows = feeds.status_items(docs, ["page_url", "owner"]).orderBy("pos").collect()
    assert [(r.id, r.is_original) for r in rows] == [(5, True), (4, False)]
    assert rows[0].created_at == 1468463935000


def test_addresses_and_fields_of_platform_json(spark):
    """Literal expected values of action, status, profile and VIP documents."""
    from feedlake import schemas
    from feedlake.operators import feeds, profiles
    doc = ('{"record":[{"actionID":"7","objectID":"11","OtherID":"22","userID":"5","userName":"n",'
           '"actionDate":"2016-07-14 10:38","body":"x"}]}')
    a = feeds.action_items(spark.createDataFrame([(doc,)], "doc string"), []).first()
    assert a.url == "http://www.taoguba.com.cn/Article/11/22" and a.ts_ms == 1468463880000
    assert schemas.URLS[40001]["status"] + "9" == "http://xueqiu.com/about/mobile-xueqiu/9"
    assert schemas.URLS[40002]["home_page"] + "9" == "http://blog.cnfol.com/9"
    p = spark.createDataFrame([("community/1.jpg!50x50.png",)], "i string").select(profiles.vip_portrait(F.col("i"))).first()
    assert p[0] == "http://xavatar.imedao.com/community/1.jpg"
    info = spark.createDataFrame([('{"userID":"5","userName":"n","fansNum":"12","vipAuth":"1","pe":"hi","pr":"a/b.png",'
                                   '"be":"3"}',)], "j string")
    v = profiles.vip_info(info, "j").first()
    assert (v.user_id, v.followers_count, v.introduction, v.marrow, v.recommend, v.vip) == ("5", 12, "hi", 3, 0, 1)
    assert v.portrait == "http://image.taoguba.com.cn/img/a/b.png" and v.home_page == "http://www.taoguba.com.cn/blog/5"
