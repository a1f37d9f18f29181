"""First users of a crawl (GRF4): what the panels of landed home pages and the pages of
top writers (MSG10) name. One walk of a page reads all its panels, each by its own link
rule; the rest is expressions and joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import json_get_or_default
from ..session import bound_batches
from . import friend_lists, lookup, messages
from .platform_pages import SELF, walked_areas

# Panels of the home pages (ids, classes) and the list of top writers.
# The link of an entry: the entry's own address, its first link or its last one.
PORTAL_40002 = [
    {"item": (None, ("user",), "#gowell"), "fields": {"link": (SELF, (), "attr", "href", 0, None)}},
    {"item": ("li", (), "BlogMUl BlockStyle1 Ml30 Fl Mt10"), "first": True,
     "fields": {"link": ("a", (), "attr", "href", 0, None)}},
    {"item": ("li", (), "#goStock"), "fields": {"link": ("a", (), "attr", "href", -1, None)}},
]
PORTAL_40004 = [{"item": ("a", (), "tgb_mr05"), "first": True, "fields": {"link": (SELF, (), "attr", "href", 0, None)}}]
TOP_40004 = [{"item": ("li", (), ("#topics", "<ul")), "first": True, "fields": {"link": ("a", (), "attr", "href", 0, None)}}]
USER_LINK = len("blog/")   # 40004: the id starts behind it


def panel_links(pages: DataFrame, panels: list) -> DataFrame:
    """``pages(page_url, html)`` -> ``page_url, panel, pos, link`` in page order; an entry
    without a link names nobody."""
    bound_batches(pages.sparkSession)
    found = pages.select("page_url", F.inline(walked_areas(F.col("html").cast("string"), panels)))
    return found.select("page_url", F.col("area").alias("panel"), "pos", F.try_element_at("fields", F.lit("link")).alias("link")) \
        .where(F.length("link") > 0)


def focus_tasks(pages: DataFrame) -> DataFrame:
    """40002: a crawl task for the list of accounts that each panel's user follows."""
    url = F.concat("link", F.lit(schemas.FOCUS_LIST))
    return panel_links(pages, PORTAL_40002).select("page_url", "panel", "pos", messages.crawl_task(
        F.lit(40002), url, schemas.RESULT_CRAWL).alias("task"))


def _user_id() -> Column:
    return F.nullif(F.substring("link", USER_LINK + 1, 100), F.lit(""))


def top_page_requests(spark: SparkSession, pages: int = schemas.TOP_PAGES_40004) -> DataFrame:
    """MSG10: ``page_no, url`` of the pages 1..``pages`` of top writers of 40004."""
    url = F.concat(F.lit(schemas.URLS[40004]["top_page"]), F.col("page_no").cast("string"))
    return spark.range(1, pages + 1).toDF("page_no").select("page_no", url.alias("url"))


def _two_pages(users: DataFrame) -> DataFrame:
    """Users -> their friend list and their info document."""
    at = schemas.URLS[40004]
    return messages.fanout(users, {"friends": messages.build_url(at["friend_list"], "user_id"),
                                   "info": messages.build_url(at["user_info"], "user_id")})


def panel_users(pages: DataFrame, store: DataFrame) -> DataFrame:
    """40004: the users of the home page's panel -> their info document and friend list
    are looked up. ``user_id, kind, url, hit, name, friends, task``: an info document
    that is stored gives the user's name (as PROF8), a friend list its length and an
    acknowledgement, or another crawl if it is broken (GRF3); a page that is not stored,
    or an info document that is no JSON, a crawl task."""
    users = panel_links(pages, PORTAL_40004).select(_user_id().alias("user_id")).where("user_id is not null").distinct()
    lk = lookup.lookup_by_url(_two_pages(users), store, "url", ("html",), prefix="")
    stored = ~lookup.is_miss(lookup.MISS_NULL_OR_EMPTY, url=None, html="html")
    keys = ["user_id", "kind", "url"]

    def task(result) -> Column:
        return messages.crawl_task(F.lit(40004), "url", result).alias("task")

    info = stored & (F.col("kind") == "info")
    read = F.try_parse_json("html").isNotNull()
    known = lk.where(info & read).select(*keys, F.lit(True).alias("hit"), json_get_or_default("html", "userName").alias("name"))
    lists = lk.where(stored & (F.col("kind") == "friends"))
    _, status = friend_lists.parse(lists.select("user_id", F.col("html").alias("xml")))
    parsed = lists.select(*keys).join(status, "user_id").select(
        *keys, F.lit(True).alias("hit"), F.when(F.col("result") == schemas.RESULT_PARSED, F.col("total")).alias("friends"), task(F.col("result")))
    asked = lk.where(~stored | (info & ~read)).select(*keys, F.lit(False).alias("hit"), task(schemas.RESULT_CRAWL))
    return known.unionByName(parsed, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)


def top_writer_tasks(spark: SparkSession, store: DataFrame) -> DataFrame:
    """40004: pages 1..5 of top writers -> a crawl task for the friend list and the info
    document of each writer, in page order; a page that is not stored, its own task."""
    lk = lookup.lookup_by_url(top_page_requests(spark), store, "url", ("html",), prefix="")
    miss = lookup.is_miss(lookup.MISS_NULL_OR_EMPTY, url=None, html="html")
    found = lk.where(~miss).select(F.col("url").alias("page_url"), "html")
    users = panel_links(found, TOP_40004).select("page_url", "pos", _user_id().alias("user_id")).where("user_id is not null")
    tasks = _two_pages(users).select("page_url", "pos", "user_id", "kind", messages.crawl_task(
        F.lit(40004), "url", schemas.RESULT_CRAWL).alias("task"))
    own = lk.where(miss).select(F.col("url").alias("page_url"), messages.crawl_task(
        F.lit(40004), "url", schemas.RESULT_CRAWL).alias("task"))
    return tasks.unionByName(own, allowMissingColumns=True)
