"""The platforms' pages of users, in their own markup, as a page table keyed by
address: what the batch jobs look up. Pages that were never crawled are left out, and
some are broken, by fixed id rules; the oracles state the expected fields from the
``users`` rows and these rules and never read the markup.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.text import spread
from . import standins

# --- fixed values: tags, classes and ids of the platforms' pages ---------------
COUNT_LABEL = "共"


def cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _text(c) -> Column:
    return c.cast("string")


def blog_home_html() -> Column:
    """40002: a user's home page."""
    uid = F.col("user_id")
    return cat('<html><div class="BloggerName"><strong>', F.col("name"), '</strong></div><p id="BlogNameLoad">  likes ',
               F.col("segment"), " </p>", F.when(uid % 3 == 0, '<i class="ApproveIco"></i>').otherwise(""),
               F.when(uid % 4 == 1, "").otherwise(cat('<img src="logo.png"><div class="BloggerPic"><a>', F.when(uid % 4 == 2, "").otherwise(
                   cat('<img src="http://pic/', _text(uid), '.png">')), "</a></div>")), "</html>")


def blog_article_html(time: Column) -> Column:
    """40002: an article page of a user; some without title or with a broken counter."""
    uid = F.col("user_id")
    return cat('<html><div class="ArticleBox NewArtbox">', F.when(uid % 17 == 0, "").otherwise(cat("<h1><a>", F.col("name"), "</a></h1>")),
               "</div>", F.when(uid % 2 == 0, '<i class="Recom"></i>').otherwise(""), '<span class="MBTime"> ', time,
               ' </span><b id="transshipmentnum">', F.when(uid % 11 == 0, "?").otherwise(_text(uid % 13)),
               '</b><b id="ArticleCommentNum">', _text(uid % 7), "</b></html>")


def blog_list_html(page: Column, label: bool) -> Column:
    """40002: list page number ``page`` of a user, with (uid + page) % 3 links; the
    first page says how many there are."""
    uid = F.col("user_id")
    n = (uid + page) % 3
    ks = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(ks, lambda k: cat('<li><a class="ArtTit" href="', link(page, k), '">t</a><span>2016-0',
                                         _text(4 + (uid + page + k) % 3), "-11</span></li>"))
    head = cat('<b class="CoRed">', COUNT_LABEL, " ", _text(pages_of()), "</b>") if label else F.lit("")
    return cat("<html>", head, "<ul>", F.array_join(rows, ""), "</ul></html>")


def pages_of() -> Column:
    return F.col("user_id") % 4 + 1


def link(page: Column, k: Column) -> Column:
    return cat(schemas.URLS[40002]["home_page"], _text(F.col("user_id")), "/article/", _text(page * 10 + k))


def blog_table_html() -> Column:
    """40004: a user's blog table; the second row of some does not parse."""
    uid = F.col("user_id")

    def row(k):
        counts = F.when((uid % 6 == 0) & (k == 2), F.lit("-")).otherwise(cat(_text(uid), "/", _text(k)))
        return cat('<tr><td><img src="/img/', F.when(k % 2 == 0, "icon43.gif").otherwise("icon1.gif"), '"></td><td><a href="Article/',
                   _text(uid), "/", _text(k), '" title="title ', _text(k), " of ", F.col("name"), '">t</a></td><td>', counts,
                   "</td><td>2016-07-14</td></tr>")

    i = F.when(uid % 5 > 0, F.sequence(F.lit(1).cast("long"), uid % 5)).otherwise(F.array().cast("array<bigint>"))
    return cat('<html><table class="blogtable"><tr><td>head</td></tr>', F.array_join(F.transform(i, row), ""),
               "<tr><td>foot</td></tr></table></html>")


def info_json() -> Column:
    """40004: user-info document (all strings); some keys missing, some documents broken."""
    k = F.col("nation_key")
    doc = cat('{"userID":"', _text(F.col("user_id")), '","userName":"', F.col("name"), '","fansNum":"',
              _text(F.col("followers_count")), '"',
              F.when(k % 3 != 0, cat(',"vipAuth":"', _text(k % 2), '"')).otherwise(""),
              F.when(k % 4 != 0, cat(',"be":"', _text(k % 5), '"')).otherwise(""),
              F.when(k % 5 != 0, cat(',"us":"', _text(k), '"')).otherwise(""),
              ',"pe":"p', _text(k), '","pr":"r', _text(k), '"}')
    return F.when(F.col("user_id") % 11 == 0, F.substring(doc, 1, 20)).otherwise(doc)


def status_html() -> Column:
    """40001: a home page with uid % 3 statuses in a script; every second one untitled."""
    uid = F.col("user_id")
    i = F.when(uid % 3 > 0, F.sequence(F.lit(0).cast("long"), uid % 3 - 1)).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(i, lambda k: cat(
        '{"id":', _text(uid * 10 + k), ',"user_id":', _text(uid), ',"title":', F.when(k % 2 == 1, "null").otherwise(
            cat('"on ', F.col("segment"), '"')), ',"created_at":', _text(1460000000000 + uid * 60000 + k), ',"retweet_count":',
        _text(uid % 13), ',"reply_count":', _text(k), ',"retweeted_status":null}'))
    return cat("<html><head><title>", F.col("name"), '</title></head><body><script>var a = 1;</script><script>SNB.data.statuses = {"statuses":[',
               F.array_join(rows, ","), "]};\n  SNB.data.statusType = 1;</script></body></html>")


def paid_article_html() -> Column:
    """40003: an article page of a user; the read count of some does not parse."""
    uid = F.col("user_id")
    return cat('<html><a class="author-avatar" href="authorHome.htm?theId=', _text(uid), '">x</a><div class="article-container"><h2>',
               F.col("name"), '</h2></div><div class="summary-footer"><span><i>浏览：', F.when(uid % 19 == 0, "many").otherwise(_text(uid * 2)),
               "次</i><i>时间：2016年07月14日 10:38:55</i>", F.when(uid % 3 == 0, cat("<i>", _text(uid % 50), "</i>")).otherwise(""),
               "</span></div>", F.when(uid % 4 == 0, cat('<div class="float-r goOrder"><strong>', _text(uid % 9), ".5</strong></div>"))
               .otherwise(""), "</html>")


def paid_link(k: Column) -> Column:
    return cat("articleDetails.htm?articleId=", _text(F.col("user_id") * 10 + k))


def author_html() -> Column:
    """40003: an author's page with uid % 3 articles; the second row of some has no link,
    some have no list."""
    uid = F.col("user_id")
    ks = F.when(uid % 3 > 0, F.sequence(F.lit(0).cast("long"), uid % 3 - 1)).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(ks, lambda k: F.when((uid % 13 == 0) & (k == 1), "<tr><td>gone</td></tr>").otherwise(
        cat('<tr><td><a href="', paid_link(k), '">t</a></td><td><a href="other">o</a></td></tr>')))
    name = F.when(uid % 10 == 7, "list2").otherwise("list1")
    return cat('<html><table id="', name, '">', F.array_join(rows, ""), "</table></html>")


def author_pages(spark: SparkSession, d: str) -> DataFrame:
    """40003: author and article pages of all users; some never crawled."""
    u, uid, k = spread(standins.users(spark, d)), F.col("user_id"), F.col("k")
    at = schemas.URLS[40003]
    arts = u.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1).cast("long")))).where((uid + k) % 4 != 2)
    return _rows(u.where(uid % 5 != 1), 40003, cat(at["author"], _text(uid)), author_html()).unionByName(
        _rows(arts, 40003, cat(at["home_page"], paid_link(k)), paid_article_html()))


def detail_pages(spark: SparkSession, d: str) -> DataFrame:
    """40005: the stored pages of that platform as detail pages. The paragraphs of a given
    page are the content of its card, the headline is the reason; by page id some documents
    are cut short (%7 = 1), some have no card (%11 = 3); empty pages stay empty."""
    p, pid = standins.page_store(spark, d).where("platform_id = 40005"), F.col("page_id")
    body = F.regexp_replace(F.array_join(F.regexp_extract_all("html", F.lit("<p>(.*?)</p>"), 1), " "), "<[^>]*>", "")
    reason = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    card = cat('<div class="WB"><div ', F.when(pid % 11 == 3, "data-id").otherwise("tbinfo"), '="ouid=1"><div node-type="feed_list_content"> ', body,
               '</div><div node-type="feed_list_reason">', reason, '</div></div><div tbinfo="ouid=2">',
               '<div node-type="feed_list_content">second card</div></div></div>')
    card = F.when(pid % 11 == 3, F.regexp_replace(card, '<div tbinfo.*$', "</div>")).otherwise(card)
    doc = F.to_json(F.struct(F.lit(schemas.DETAIL_SCRIPT).alias("ns"), card.alias("html")))
    doc = F.when(pid % 7 == 1, F.substring(doc, F.lit(1), F.length(doc) - 2)).otherwise(doc)
    html = cat("<html><head><title>", F.regexp_extract("html", "<title>([^<]*)</title>", 1), schemas.DETAIL_TITLE_SUFFIX,
               "</title></head><body><script>var config = {};</script>", schemas.SCRIPT_HEAD, doc, schemas.SCRIPT_TAIL, "</body></html>")
    return p.select("page_id", "table_name", "row_key", "url", F.when(F.col("html") == "", "").otherwise(html).alias("html"))


def post_pages(spark: SparkSession, d: str) -> DataFrame:
    """40004: every stored page of that platform as a post. The headline and the paragraphs
    are its content blocks, its links the images of the frame: by place the source, a
    lazily loaded one, decoration; some pages (id %9 = 4) have no frame."""
    p, pid = standins.page_store(spark, d).where("platform_id = 40004"), F.col("page_id")
    body = F.regexp_replace(F.array_join(F.regexp_extract_all("html", F.lit("<p>(.*?)</p>"), 1), " "), "<[^>]*>", "")
    links = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)">'), 1)
    images = F.transform(links, lambda x, i: F.when(i % 3 == 0, cat('<img src="http://i.example/', x, '">')).when(
        i % 3 == 1, cat('<img src="/blank.gif" data-original="http://lazy.example/', x, '"/>')).otherwise(
        cat('<img src="http://css.taoguba.com.cn/', x, '">')))
    frame = F.when(pid % 9 == 4, "p_none").otherwise("p_wenz")
    html = cat("<html><head><title>", F.regexp_extract("html", "<title>([^<]*)</title>", 1), '_淘股吧</title></head><img src="http://i.example/top">',
               '<div class="p_coten">', F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), '</div><div class="', frame, '"><div class="p_coten">', body,
               "</div>", F.array_join(images, ""), '</div><div class="p_wenz2"><img src="http://i.example/foot"></div></html>')
    return p.select("page_id", "table_name", "row_key", "url", F.when(F.col("html") == "", "").otherwise(html).alias("html"))


def card_home_html() -> Column:
    """40005: a user's home page of two documents; some without the counter document, with
    one cell or with a count that is no number, some without introduction."""
    uid = F.col("user_id")
    head = F.to_json(F.struct(F.lit("pl.header.head.index").alias("ns"), cat(
        '<div class="pf_photo"><img src="http://face/', _text(uid), '.jpg"></div><h1 class="username"> ', F.col("name"), " </h1>",
        F.when(uid % 23 == 0, "").otherwise(cat('<div class="pf_intro">likes\n ', F.col("segment"), "</div>")),
        F.when(uid % 3 == 0, '<a href="x?key=profile_head&value=vuser_guest">v</a>').otherwise("")).alias("html")))
    cell = lambda c: cat("<td><a><strong>", c, "</strong></a></td>")
    counts = F.to_json(F.struct(F.lit("").alias("ns"), F.lit("Pl_Core_T8CustomTriColumn__3").alias("domid"), cat(
        "<table><tr>", cell(F.lit("12")), F.when(uid % 19 == 0, "").otherwise(cell(F.when(uid % 17 == 0, "many").otherwise(
            _text(F.col("followers_count"))))), "</tr></table>").alias("html")))
    script = lambda doc: cat(schemas.SCRIPT_HEAD, doc, schemas.SCRIPT_TAIL, "\n")
    return cat("<html>", script(F.lit('{"ns":"pl.top.index","html":"<i></i>"}')), script(head),
               F.when(uid % 13 == 0, "").otherwise(script(counts)), "</html>")


PANEL_USERS = 64   # users on one landed home page


def _panels(u: DataFrame, html) -> DataFrame:
    """Landed home pages ``chunk, html`` that list ``PANEL_USERS`` users each, by id."""
    many = u.groupBy((F.col("user_id") / PANEL_USERS).cast("long").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.col("user_id"))).alias("ids"))
    return many.select("chunk", html.alias("html"))


def _each(area: int, areas: int, row) -> Column:
    """``row(id)`` of the users whose id gives ``area``, in order."""
    return F.array_join(F.transform(F.filter("ids", lambda x: x % areas == area), row), "")


def blog_portals(spark: SparkSession, d: str) -> DataFrame:
    """40002: landed home pages with three panels and a fourth, of the second one's class,
    that is not read; users go to the panels by id % 4."""
    home = schemas.URLS[40002]["home_page"]
    at = lambda x: cat(home, _text(x))
    again = cat(home, "0")
    rows = [lambda x: cat('<p><a class="user" href="', at(x), '">u</a><a class="pic" href="', again, '">p</a></p>'),
            lambda x: cat('<li><a href="', at(x), '">u</a><a href="', again, '">more</a></li>'),
            lambda x: cat('<li><a href="', again, '">stock</a><a href="', at(x), '">u</a></li>'),
            lambda x: cat('<li><a href="', at(x), '">u</a></li>')]
    one, two, three, four = (_each(i, 4, r) for i, r in enumerate(rows))
    listed = '<ul class="BlogMUl BlockStyle1 Ml30 Fl Mt10">'
    html = cat('<html><a class="user" href="', again, '">me</a><div id="gowell">', one, "</div>", listed, two, "</ul>", '<div id="goStock"><ul>',
               three, "</ul></div>", listed, four, "</ul></html>")
    return _panels(standins.users(spark, d), html).select(cat(home, "?seen=", _text(F.col("chunk"))).alias("page_url"), "html")


def writer_portals(spark: SparkSession, d: str) -> DataFrame:
    """40004: landed home pages; the panel of the week lists the users with id % 2 = 0,
    a second one is not read."""
    rows = lambda x: cat('<li><a href="blog/', _text(x), '">u</a></li>')
    html = cat('<html><ul class="tgb_mr05">', _each(0, 2, rows), '</ul><ul class="tgb_mr05">', _each(1, 2, rows), "</ul></html>")
    return _panels(standins.users(spark, d), html).select(
        cat(schemas.URLS[40004]["home_page"], "?seen=", _text(F.col("chunk"))).alias("page_url"), "html")


def friend_pages(spark: SparkSession, d: str) -> DataFrame:
    """40004: users' friend lists with id % 4 friends; every eleventh is cut short, some
    were never crawled."""
    u, uid = standins.users(spark, d), F.col("user_id")
    n = uid % 4
    xml = cat('<root total="', _text(n), '">', F.repeat(F.lit('<keyword userID="1" userName="n"/>'), n.cast("int")), "</root>")
    xml = F.when(uid % 11 == 5, F.substring(xml, F.lit(1), F.length(xml) - 5)).otherwise(xml)
    return _rows(u.where(uid % 3 != 1), 40004, cat(schemas.URLS[40004]["friend_list"], _text(uid)), xml)


TOP_USERS = 20   # users on a page of top writers


def top_pages(spark: SparkSession, d: str) -> DataFrame:
    """40004: landed pages 1.. of top writers, the most followed first (a top-k report);
    page 4 was never crawled."""
    k = TOP_USERS * schemas.TOP_PAGES_40004
    top = standins.users(spark, d).orderBy(F.col("followers_count").desc(), "user_id").limit(k)
    ids = F.array_sort(F.collect_list(F.struct(-F.col("followers_count"), "user_id")))
    pages = top.agg(ids.alias("xs")).select(F.posexplode(F.transform("xs", lambda x: x["user_id"])).alias("i", "uid"))
    no = (F.col("i") / TOP_USERS).cast("int") + 1
    row = cat('<li><a href="blog/', _text(F.col("uid")), '">u</a><ul><li><a href="Article/1">a</a></li></ul></li>')
    html = pages.groupBy(no.alias("no")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("i"), row.alias("r")))), lambda x: x["r"]), "").alias("rows"))
    return _rows(html.where("no <> 4"), 40004, cat(schemas.URLS[40004]["top_page"], _text(F.col("no"))),
                 cat('<html><ul><li><a href="blog/0">x</a></li></ul><div id="topics"><ul>', F.col("rows"), "</ul></div></html>"))


def _rows(df: DataFrame, platform: int, url: Column, html: Column) -> DataFrame:
    return df.select(F.lit(str(platform)).alias("table_name"), url.alias("row_key"), url.alias("url"), html.alias("html"))


def site_pages(spark: SparkSession, d: str) -> DataFrame:
    """``table_name, row_key, url, html`` of all users' crawled pages."""
    u, uid = spread(standins.users(spark, d)), F.col("user_id")
    s, rows = _text(uid), _rows
    lists = cat(schemas.URLS[40002]["article_list"], s)
    one = F.lit(1).cast("long")
    more = u.withColumn("page", F.explode(F.sequence(F.lit(2).cast("long"), F.lit(4).cast("long")))).where(F.col("page") <= pages_of())
    links = more.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1).cast("long")))).where(
        F.col("k") < (uid + F.col("page")) % 3)
    page, k = F.col("page"), F.col("k")
    parts = [
        rows(u.where(uid % 8 != 7), 40001, cat(schemas.URLS[40001]["home_page"], s), status_html()),
        rows(u.where(uid % 5 != 4), 40002, cat(schemas.URLS[40002]["home_page"], s), blog_home_html()),
        rows(u.where(uid % 7 != 6), 40002, lists, blog_list_html(one, True)),
        rows(more.where((uid + page) % 5 != 0), 40002, cat(lists, "?page=", _text(page)), blog_list_html(page, False)),
        rows(links.where((uid + k) % 4 != 3), 40002, link(page, k), blog_article_html(F.lit("2016-05-11 10:00"))),
        rows(u.where(uid % 9 == 0), 40003, cat(schemas.URLS[40003]["list_page"], s), cat("<html><p>", F.col("name"), "</p></html>")),
        rows(u.where(uid % 5 != 3), 40004, cat(schemas.URLS[40004]["blog"], s), blog_table_html()),
        rows(u.where(uid % 6 != 5), 40004, cat(schemas.URLS[40004]["user_info"], s), info_json()),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
