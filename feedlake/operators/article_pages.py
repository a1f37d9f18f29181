"""Article pages and article tables of three platforms (FEED8, FEED11, ART6,
ART7), through the walker of ``platform_pages``: the walker finds elements,
expressions parse them. A page or row that cannot be parsed gets the recrawl
task the application sends for it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates
from ..functions.urls import after_marker, last_segment
from ..session import bound_batches
from . import messages
from .platform_pages import SELF, page_items, walked, walked_areas

# Tags, classes and ids of the pages; see platform_pages.SPECS.
BLOG_ARTICLE = {40002: {
    "item": ("html", (), None),
    "fields": {
        "title": ("a", (), "text", None, 0, ("ArticleBox NewArtbox", "<h1")),
        "recommend": (None, ("Recom",), "count", None, 0, None),
        "time": (None, ("MBTime",), "text", None, 0, None),
        "reposts": (None, ("#transshipmentnum",), "text", None, 0, None),
        "comments": (None, ("#ArticleCommentNum",), "text", None, 0, None),
    }}}
BLOG_LINKS = {40002: {
    "item": ("li", (), None),
    "fields": {"url": ("a", ("ArtTit",), "attr", "href", 0, None), "time": ("span", (), "text", None, 0, None)}}}
PAID_ARTICLE = {40003: {
    "item": ("html", (), None),
    "fields": {
        "author": (None, ("author-avatar",), "attr", "href", 0, None),
        "title": ("h2", (), "text", None, 0, "article-container"),
        "footer": ("i", (), "list", None, 0, ("summary-footer", "<span")),
        "price": ("strong", (), "text", None, 0, "float-r goOrder"),
    }}}
BLOG_TABLE = {40004: {
    "item": ("tr", (), "blogtable"),
    "fields": {
        "title": ("a", (), "attr", "title", 0, None), "href": ("a", (), "attr", "href", 0, None),
        "icon": ("img", (), "attr", "src", 0, None), "cells": ("td", (), "list", None, 0, None),
    }}}
CARD = {"item": (None, ("[tbinfo]",), None),
        "fields": {"content": (None, ("[node-type=feed_list_content]",), "list", None, 0, None),
                   "reason": (None, ("[node-type=feed_list_reason]",), "list", None, 0, None)}}
AUTHOR_LIST = [{"item": ("tr", (), "#list1"), "fields": {"link": ("a", (), "attr", "href", 0, None)}},
               {"item": (None, ("#list1",), None), "fields": {}}]
POST = [{"item": (None, ("p_coten",), None), "fields": {"text": (SELF, (), "text", None, 0, None)}},
        {"item": ("img", (), "p_wenz"), "first": True,
         "fields": {"src": (SELF, (), "attr", "src", 0, None), "lazy": (SELF, (), "attr", "data-original", 0, None)}},
        {"item": (None, ("p_wenz",), None), "fields": {}}]
POST_TITLE_SUFFIX, STYLE_HOST = "_淘股吧", "http://css.taoguba"
RECOMMEND_ICON = "icon43.gif"
READ_UNIT = "次"


def _walked(pages: DataFrame, platform: int, specs: dict) -> DataFrame:
    """``pages(id, page_url, html)`` -> ``id, page_url, pos, x`` (map of raw fields)."""
    return page_items(pages, platform, "id", "html", specs, keep=("page_url",)).withColumnRenamed("fields", "x")


def _x(name: str) -> Column:
    return F.try_element_at("x", F.lit(name))


def blog_links(pages: DataFrame, month: str) -> DataFrame:
    """FEED11: links of a 40002 list page whose date holds ``month``."""
    w = _walked(pages, 40002, BLOG_LINKS)
    return w.where(_x("time").contains(month)).select("id", "pos", _x("url").alias("url"), _x("time").alias("time"))


def blog_articles(pages: DataFrame, month: str) -> DataFrame:
    """ART6: one row per 40002 article page of ``month``; a page that does not
    parse has only its recrawl task."""
    w = _walked(pages, 40002, BLOG_ARTICLE)
    reposts, comments = _x("reposts").try_cast("int"), _x("comments").try_cast("int")
    dated = F.coalesce(F.trim(_x("time")).contains(month), F.lit(False))
    bad = _x("title").isNull() | _x("time").isNull() | (dated & (reposts.isNull() | comments.isNull()))
    rows = w.where(bad | dated)
    user = F.substring(F.substring_index("page_url", "/article/", 1), 23, 1 << 20)

    def ok(c):
        return F.when(~bad, c)

    return rows.select("page_url", ok(user).alias("user_id"), ok(_x("title")).alias("title"),
                       ok(F.coalesce(_x("recommend").try_cast("int"), F.lit(0)) > 0).alias("recommend"),
                       ok(F.trim(_x("time"))).alias("time"), ok(reposts).alias("reposts"), ok(comments).alias("comments"),
                       F.when(bad, messages.crawl_task(F.lit(40002), "page_url", schemas.RESULT_CRAWL)).alias("task"))


def paid_articles(pages: DataFrame, zone: str = "Asia/Shanghai") -> DataFrame:
    """ART7: one row per 40003 article page; read count and time behind a
    three-character label; no third footer cell: nobody bought; no price tag: free."""
    w = _walked(pages, 40003, PAID_ARTICLE)
    cells = F.coalesce(F.from_json(_x("footer"), "array<string>"), F.array().cast("array<string>"))
    read = F.replace(F.substring(F.get(cells, F.lit(0)), 4, 100), F.lit(READ_UNIT), F.lit("")).try_cast("int")
    ts = F.floor(dates.string_to_millis(F.substring(F.get(cells, F.lit(1)), 4, 100), dates.FMT_CN, zone) / 1000)
    buy = F.when(F.size(cells) > 2, F.get(cells, F.lit(2)).try_cast("int")).otherwise(0)
    price = F.when(_x("price").isNull(), 0.0).otherwise(_x("price").try_cast("double"))
    user = after_marker(_x("author"), "theId=")
    bad = F.isnull(user) | _x("title").isNull() | F.isnull(read) | F.isnull(ts) | F.isnull(buy) | F.isnull(price)

    def ok(c):
        return F.when(~bad, c)

    return w.select("page_url", ok(user).alias("user_id"), ok(_x("title")).alias("title"), ok(read).alias("read_count"),
                    ok(buy).alias("buy_count"), ok(price).alias("price"), ok(ts.cast("long")).alias("ts_s"),
                    F.when(bad, messages.crawl_task(F.lit(40003), "page_url", schemas.RESULT_CRAWL)).alias("task"))


def card_bodies(pages: DataFrame) -> DataFrame:
    """ART5: ``pages(.., html)`` -> the same columns without html, ``title`` and ``body``
    of a 40005 detail page: the html inside the JSON document of the last script that
    names the detail view (else of the first script), of it the first card's content
    and the reason it quotes, joined by a space. A script that is no JSON object gives
    the empty body; a page without a script, a document without html or html without a
    card is broken: body NULL."""
    bound_batches(pages.sparkSession)
    keep = [c for c in pages.columns if c != "html"]
    head, tail = len(schemas.SCRIPT_HEAD), len(schemas.SCRIPT_TAIL)
    html = F.col("html").cast("string")
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*>.*?</script>"), 0)
    named = F.filter(scripts, lambda s: s.contains(schemas.DETAIL_SCRIPT))
    script = F.coalesce(F.try_element_at(named, F.lit(-1)), F.try_element_at(scripts, F.lit(1)))
    title = F.replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(schemas.DETAIL_TITLE_SUFFIX), F.lit(""))
    whole = F.length(script) >= head + tail
    doc = F.try_parse_json(F.when(whole, F.substring(script, F.lit(head + 1), F.length(script) - (head + tail))))
    read = pages.select(*keep, title.alias("title"), whole.alias("_whole"), doc.alias("_doc"))
    inner = F.try_variant_get("_doc", "$.html", "string")
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    read = read.select(*keep, "title", "_whole", is_object.alias("_object"), inner.alias("_html"))
    read = read.select(*keep, "title", "_whole", "_object", F.get(walked(F.col("_html"), CARD), F.lit(0)).alias("_card"))

    def text(name: str) -> Column:
        parts = F.from_json(F.try_element_at("_card", F.lit(name)), "array<string>")
        return F.trim(F.regexp_replace(F.coalesce(F.array_join(parts, " "), F.lit("")), r"\s+", " "))

    body = F.when(F.col("_card").isNotNull(), F.concat(text("content"), F.lit(" "), text("reason")))
    return read.select(*keep, "title", F.when(F.col("_whole") & ~F.col("_object"), F.lit("")).otherwise(body).alias("body"))


def posts_40004(pages: DataFrame) -> DataFrame:
    """ART4: ``pages(.., html)`` -> the same columns without html, ``title`` without the
    site's name, ``body`` (texts of all content blocks, joined by a space) and ``images``
    of the first frame: the source, or the lazily loaded address where the source is
    none, without the site's own decoration. A page without a frame is broken: body and
    images NULL."""
    bound_batches(pages.sparkSession)
    keep = [c for c in pages.columns if c != "html"]
    html = F.col("html").cast("string")
    title = F.replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(POST_TITLE_SUFFIX), F.lit(""))
    read = pages.select(*keep, title.alias("title"), walked_areas(html, POST).alias("_xs"))

    def of(area: int) -> Column:
        return F.transform(F.filter("_xs", lambda x: x["area"] == area), lambda x: x["fields"])

    def address(x: Column) -> Column:
        src, lazy = (F.coalesce(F.try_element_at(x, F.lit(k)), F.lit("")) for k in ("src", "lazy"))
        return F.when(src.startswith("http://"), src).otherwise(lazy)

    body = F.trim(F.regexp_replace(F.array_join(F.transform(of(0), lambda x: F.try_element_at(x, F.lit("text"))), " "), r"\s+", " "))
    images = F.filter(F.transform(of(1), address), lambda u: ~u.startswith(STYLE_HOST))
    framed = F.size(of(2)) > 0
    return read.select(*keep, "title", F.when(framed, body).alias("body"), F.when(framed, images).alias("images"))


def author_links(pages: DataFrame) -> DataFrame:
    """FEED10: ``pages(page_url, html)`` of 40003 authors -> ``page_url, links`` (addresses
    of their articles in page order, up to the first row without a link) and ``broken``:
    such a row, or no list at all."""
    bound_batches(pages.sparkSession)
    read = pages.select("page_url", walked_areas(F.col("html").cast("string"), AUTHOR_LIST).alias("xs"))
    link = F.transform(F.filter("xs", lambda x: x["area"] == 0), lambda x: F.try_element_at(x["fields"], F.lit("link")))
    read = read.select("page_url", link.alias("l"), F.exists("xs", lambda x: x["area"] == 1).alias("listed"))
    stop = F.array_position(F.transform("l", lambda x: x.isNull()), True)
    kept = F.when(stop == 0, F.col("l")).otherwise(F.slice("l", F.lit(1), stop.cast("int") - 1))
    links = F.transform(kept, lambda x: F.concat(F.lit(schemas.MOER_HOST), x))
    return read.select("page_url", links.alias("links"), (~F.col("listed") | (stop > 0)).alias("broken"))


def blog_table(pages: DataFrame, zone: str = "Asia/Shanghai") -> DataFrame:
    """FEED8: rows of a 40004 blog table without its head and foot row, up to
    the first row that does not parse; that row's place carries the recrawl task."""
    bound_batches(pages.sparkSession)

    def row(x: Column, pos: Column) -> Column:
        at = lambda name: F.try_element_at(x, F.lit(name))
        cells = F.coalesce(F.from_json(at("cells"), "array<string>"), F.array().cast("array<string>"))
        counts = F.split(F.get(cells, F.size(cells) - 2), "/")
        return F.struct(pos.alias("pos"), at("title").alias("title"), at("href").alias("href"),
                        at("icon").contains(RECOMMEND_ICON).alias("recommend"),
                        F.get(counts, F.lit(0)).try_cast("int").alias("read_count"),
                        F.get(counts, F.lit(1)).try_cast("int").alias("comment_count"),
                        dates.string_to_millis(F.get(cells, F.size(cells) - 1), dates.FMT_DAY, zone).alias("ts"))

    page = (pages.select("page_url", walked(F.col("html").cast("string"), BLOG_TABLE[40004]).alias("xs"))
            .withColumn("r", F.transform("xs", row))
            .withColumn("r", F.slice("r", F.lit(2), F.greatest(F.size("r") - 2, F.lit(0)))))
    fine = F.transform("r", lambda r: r["title"].isNotNull() & r["recommend"].isNotNull() & r["read_count"].isNotNull()
                       & r["comment_count"].isNotNull() & r["ts"].isNotNull())
    stop = F.array_position(fine, False)
    kept = F.when(stop == 0, F.col("r")).otherwise(F.slice("r", F.lit(1), stop.cast("int")))
    out = page.select("page_url", stop.alias("stop"), F.posexplode(kept).alias("i", "x"))
    bad = F.col("i") + 1 == F.col("stop")

    def ok(c):
        return F.when(~bad, c)

    return out.select("page_url", (F.col("i") + 1).alias("pos"), ok(last_segment("page_url")).alias("user_id"),
                      ok(F.col("x.title")).alias("title"),
                      ok(F.concat(F.lit(schemas.URLS[40004]["home_page"]), F.col("x.href"))).alias("url"),
                      *[ok(F.col("x." + c)).alias(c) for c in ("recommend", "read_count", "comment_count", "ts")],
                      F.when(bad, messages.crawl_task(F.lit(40004), "page_url", schemas.RESULT_RECRAWL)).alias("task"))
