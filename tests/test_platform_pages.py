"""Per-platform page walkers on hand-made pages (FIXTURES.md shapes; the
texts are our own)."""
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import increments as inc
from feedlake.operators import platform_pages as pp

BLOG = """<html><body><div id="Tab1"><div class="TabItem"><ul>
<li><div class="UserBox"><a class="Name" href="http://blog.example/user/3001">Ann</a>
  <a class="Tit" href="http://blog.example/a/1">Rates and rice<i class="TuiJian">rec</i></a></div>
  <div class="HandleBox"><span>read 9</span><span>repost 4</span><span>comment 2</span></div></li>
<li><div class="UserBox"><a class="Name" href="http://blog.example/user/3002/">Bo</a>
  <a class="Tit" href="http://blog.example/a/2">Copper week</a></div>
  <div class="HandleBox"><span>read 1</span><span>repost 0</span><span>comment x</span></div></li>
<li><div class="UserBox"><a class="Name" href="http://blog.example/user/3003">Cy</a>
  <a class="Tit" href="http://blog.example/a/3">Old note</a></div>
  <div class="HandleBox"><span>read 5</span></div></li>
</ul></div></div></body></html>"""

TABLE = """<html><body><table class="blu authortab-list">
<tr><td><a href="articleDetails.htm?articleId=11">Paid view one</a></td><td><a href="x">more</a></td></tr>
<tr><td><a href="articleDetails.htm?articleId=12">Paid view two</a></td></tr>
<tr><td><a href="articleDetails.htm?articleId=13">Seen before</a></td></tr>
</table><table class="other"><tr><td><a href="no">not an item</a></td></tr></table></body></html>"""


def _card(cls, date, link, user="Dee", uid="1234567890", head=None, ems=None, expand=False):
    ems = ems if ems is not None else ["", "", "", "7", "", "3", "", "11"]
    em = "".join(f'<li><span class="pos"><em>{e}</em></span></li>' for e in ems)
    spec = (f'<div class="WB_media_wrap clearfix"><div class="WB_feed_spec_info SW_fun">'
            f'<div class="WB_feed_spec_cont"><h4>{head}</h4></div></div></div>') if head else ""
    exp = '<div class="WB_feed_expand">quoted</div>' if expand else ""
    return (f'<div class="{cls}"><div class="WB_detail"><a class="W_f14 W_fb S_txt1" usercard="id={uid}&refer=1">{user}</a>'
            f'<div class="WB_from S_txt2"><a title="{date}" href="{link}">t</a></div>{spec}{exp}</div>'
            f'<div class="WB_feed_handle"><ul>{em}</ul></div></div>')


CARDS = "<html><body>" + "".join([
    _card("WB_cardwrap WB_feed_type S_bg2", "2016-07-14 10:30", "/1234567890/A1?ref=home&rid=1", head="Market view"),
    _card("WB_cardwrap WB_feed_type S_bg2", "2016-07-14 10:20", "/1234567890/A2?ref=home&rid=2", expand=True),
    _card("WB_cardwrap WB_feed_type S_bg2 WB_feed_vipcover", "2016-07-14 10:40", "/1234567890/C1?ref=home&rid=9",
          ems=["", "", "", "转发", "", "ñ", "5"]),
    _card("WB_cardwrap WB_feed_type S_bg2", "2016-07-14 10:10", "/1234567890/A3"),
    _card("WB_cardwrap WB_feed_type S_bg2", "2016-07-14 10:00", "/1234567890/A4?ref=home&rid=4"),
]) + "</body></html>"


def _pages(spark, html, url="http://p/1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_list_page_40002(spark):
    items = pp.page_items(_pages(spark, BLOG), 40002)
    rows = pp.list_items_40002(items).orderBy("pos").collect()
    assert [(r.title, r.user_id, r.recommend, r.reproduce, r.comment) for r in rows] == [
        ("Rates and ricerec", "3001", 1, 4, 2), ("Copper week", "3002", 0, 0, None), ("Old note", "3003", 0, None, None)]
    # marker = the title seen last time: only the items before it are new
    m = spark.createDataFrame([(1, "Old note")], "id long, last_key string")
    new = inc.take_until_seen(pp.list_items_40002(items), m, "id", F.col("pos"), "title", "last_key")
    assert sorted(r.pos for r in new.collect()) == [0, 1]


def test_table_page_40003(spark):
    pages = _pages(spark, TABLE, "http://moer.example/authorHome.htm?theId=777")
    items = pp.page_items(pages, 40003)
    rows = pp.table_items_40003(items.join(pages.select(F.col("page_id").alias("id"), "url"), "id"),
                                F.col("url")).orderBy("pos").collect()
    assert [(r.title, r.url, r.user_id, r.price) for r in rows] == [
        ("Paid view one", pp.MOER_HOST + "articleDetails.htm?articleId=11", "777", 0.0),
        ("Paid view two", pp.MOER_HOST + "articleDetails.htm?articleId=12", "777", 0.0),
        ("Seen before", pp.MOER_HOST + "articleDetails.htm?articleId=13", "777", 0.0)]


def test_cards_40005(spark):
    items = pp.page_items(_pages(spark, CARDS), 40005)
    cards = pp.cards_40005(items)
    rows = cards.orderBy("pos").collect()
    # cover first; the expand card is skipped
    assert [r.url for r in rows] == [
        pp.WEIBO_HOST + "/1234567890/C1?type=comment", pp.WEIBO_HOST + "/1234567890/A1?type=comment",
        pp.WEIBO_HOST + "/1234567890/A3type=comment", pp.WEIBO_HOST + "/1234567890/A4?type=comment"]
    first = rows[0]
    assert (first.is_cover, first.user_id, first.forwards, first.comments, first.likes) == (True, "1234567890", 0, 5, 0)
    assert rows[1].title == "Market view" and rows[3].title == "Dee" + schemas.TITLE_SUFFIX
    assert rows[1].ts_ms == 1468463400000                       # 2016-07-14 10:30 Asia/Shanghai
    # the walk stops at the first card without a permalink (A3): A4 is not kept
    kept = inc.take_while(cards, "id", F.col("pos"), ~F.col("has_permalink"))
    assert [r.pos for r in kept.orderBy("pos").collect()] == [rows[0].pos, rows[1].pos]


HOME_40002 = """<html><body><div class="BloggerName"><strong>Eve Lin</strong></div>
<div id="BlogNameLoad">  Macro notes, weekly.  </div><span class="ApproveIco"></span></body></html>"""

HOME_40003 = """<html><body><div class="author-avatar"><img src="http://img.example/a.png"></div>
<div class="author-msg"><span> Kai </span><p><span>Energy</span></p></div>
<i class="moerv-blue"></i><i class="moerv-red"></i><b id="fansCount">1024</b>
<table class="anthor_left_bottom"><tr><td>a</td></tr><tr><td>b</td></tr><tr><td>c</td></tr>
<tr><td><p> Covers oil and gas. </p></td></tr></table></body></html>"""


def test_profile_pages(spark):
    p2 = spark.createDataFrame([(1, "http://blog.example/u/eve_lin", HOME_40002)], "page_id long, url string, html string")
    it2 = pp.page_items(p2, 40002, specs=pp.PROFILE_SPECS).join(p2.select(F.col("page_id").alias("id"), "url"), "id")
    r = pp.profile_40002(it2, F.col("url")).first()
    assert (r.user_id, r.name, r.introduction, r.vip) == ("eve_lin", "Eve Lin", "Macro notes, weekly.", True)
    p3 = spark.createDataFrame([(2, "http://moer.example/authorHome.htm?theId=88", HOME_40003),
                                (3, "http://moer.example/authorHome.htm?theId=89",
                                 HOME_40003.replace("1024", "n/a").replace('<i class="moerv-red"></i>', ""))],
                               "page_id long, url string, html string")
    it3 = pp.page_items(p3, 40003, specs=pp.PROFILE_SPECS).join(p3.select(F.col("page_id").alias("id"), "url"), "id")
    rows = {r.user_id: r for r in pp.profile_40003(it3, F.col("url")).collect()}
    a, b = rows["88"], rows["89"]
    assert (a.portrait, a.name, a.vip, a.field, a.followers_count, a.introduction, a.result) == (
        "http://img.example/a.png", "Kai", 2, "Energy", 1024, "Covers oil and gas.", 1)
    assert (b.vip, b.followers_count, b.result) == (1, None, 0)
