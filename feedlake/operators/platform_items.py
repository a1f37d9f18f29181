"""Feed pages -> one ordered item array per page, by platform (MSG3, FEED1,
FEED2, FEED3, FEED5, FEED6), and the marker rule of each platform (INC2-INC5).

``items`` dispatches on the platform id. JSON platforms are built-in
expressions; the three HTML platforms share one Arrow walker that returns each
item's raw fields, and everything after it is expressions again. Every item has
the same fields:

  title, url, user_id     article row
  key                     what the url / title marker compares
  ts                      ms of the item's own time (NULL where the page has none)
  reposts, comments, likes
  keep                    false: on the page and part of the walk, but no article
  valid                   false: the walk ends here

Marker rules (``marker_kind`` of the platform dimension): ``url`` and ``title``
stop at the item that equals the marker; ``ts`` stops at the first item not
newer than the marker (0 if none); ``head`` compares the page's newest item by
time (first wins ties) and takes the whole page or nothing.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..functions import dates
from ..functions.urls import after_marker, last_segment
from . import extract, feeds, increments
from .platform_pages import MOER_HOST, PERMALINK_MARK, SPECS, WEIBO_HOST, counters, items_of

ITEM = ("struct<title: string, url: string, user_id: string, key: string, ts: bigint, reposts: int, comments: int, "
        "likes: int, keep: boolean, valid: boolean>")


def _item(title, url, user_id, key, ts=None, reposts=None, comments=None, likes=None, keep=None, valid=None) -> Column:
    no = F.lit(0)
    return F.struct(
        title.alias("title"), url.alias("url"), user_id.alias("user_id"), key.alias("key"),
        (F.lit(None) if ts is None else ts).cast("bigint").alias("ts"),
        *[F.coalesce((no if n is None else n).cast("int"), no).alias(a)
          for n, a in ((reposts, "reposts"), (comments, "comments"), (likes, "likes"))],
        F.coalesce(F.lit(True) if keep is None else keep, F.lit(False)).alias("keep"),
        F.coalesce(F.lit(True) if valid is None else valid, F.lit(False)).alias("valid"))


def status_items(html: Column) -> Column:
    """40001: status JSON in the last script that holds it; reposts are walked
    over but give no article."""
    site = schemas.URLS[40001]["home_page"].rstrip("/")
    mark = F.lit(schemas.OWNER_MARK)
    page_title = extract.title(html)
    owner = F.when(F.instr(page_title, schemas.OWNER_MARK) > 0,
                   F.concat(F.split_part(page_title, mark, F.lit(1)), F.lit(schemas.TITLE_SUFFIX))).otherwise("")
    doc = F.try_parse_json(extract.status_text(html))
    get = F.try_variant_get

    def one(s):
        title, text = get(s, F.lit("$.title"), "string"), get(s, F.lit("$.description"), "string")
        name = F.coalesce(get(s, F.lit("$.user.screen_name"), "string"), F.lit(""))
        named = F.when(name != "", F.concat(name, F.lit(schemas.TITLE_SUFFIX))).otherwise(owner)
        shown = F.when(title.isNull(), feeds.short_headline(title, text)).when(title == "", named).otherwise(title)
        url = F.concat(F.lit(site), F.coalesce(get(s, F.lit("$.target"), "string"), F.lit("")))
        return _item(shown, url, get(s, F.lit("$.user_id"), "bigint").cast("string"), url,
                     reposts=get(s, F.lit("$.retweet_count"), "int"), comments=get(s, F.lit("$.reply_count"), "int"),
                     keep=F.is_variant_null(get(s, F.lit("$.retweeted_status"), "variant")))

    return F.transform(get(doc, F.lit("$.statuses"), "array<variant>"), one)


def action_items(html: Column, zone: str = "Asia/Shanghai") -> Column:
    """40004: action JSON; records with OtherID 0 are walked over but give no article."""
    record = F.from_json(html, schemas.ACTION_PAGE)["record"]

    def one(r):
        url = F.concat(F.lit(schemas.URLS[40004]["article"]), r["objectID"], F.lit("/"), r["OtherID"])
        ts = fn.string_to_millis(r["actionDate"], dates.FMT_ACTION, zone)
        return _item(F.concat(r["userName"], F.lit(schemas.ACTION_TITLE_SUFFIX)), url, r["userID"], url, ts=ts,
                     keep=r["OtherID"].try_cast("int") != 0)

    return F.transform(record, one)


def _raw(platform: pa.Array, html: pa.Array) -> pa.Array:
    return pa.array([[list(x.items()) for x in items_of(p.as_py(), h.as_py())] for p, h in zip(platform, html)],
                    pa.list_(pa.map_(pa.string(), pa.string())))


def html_items(platform_id: Column, page_url: Column, html: Column, zone: str = "Asia/Shanghai") -> Column:
    """40002, 40003, 40005 through the walker. The cards of 40005 stand in the
    ``html`` field of a script's JSON argument."""
    call = extract.last_script_with(html, schemas.CARDS_SCRIPT)
    cards = F.get_json_object(F.regexp_extract(call, r"(?s)^[^(]*\((.*)\)\s*;?\s*$", 1), "$.html")
    raw = F.arrow_udf(_raw, "array<map<string, string>>")(
        F.when(platform_id.isin(*SPECS), platform_id), F.when(platform_id == 40005, cards).otherwise(html))

    def get(x, name):
        return F.try_element_at(x, F.lit(name))

    def listed(x):
        last = F.element_at(F.split(F.trim(get(x, "reproduce")), " "), -1).try_cast("int")
        comment = F.element_at(F.split(F.trim(get(x, "comment")), " "), -1).try_cast("int")
        return _item(get(x, "title"), get(x, "url"), last_segment(get(x, "author")), get(x, "title"), reposts=last,
                     comments=comment, likes=get(x, "badges").try_cast("int"),
                     keep=last.isNotNull() & comment.isNotNull())  # a row that fails to parse is skipped

    def tabled(x):
        url = F.concat(F.lit(MOER_HOST), get(x, "href"))
        return _item(get(x, "title"), url, after_marker(page_url, "theId="), get(x, "title"))

    def card(x):
        user = F.coalesce(F.nullif(get(x, "user"), F.lit("")), get(x, "user_alt"))
        title = F.coalesce(F.nullif(get(x, "headline"), F.lit("")), F.concat(user, F.lit(schemas.TITLE_SUFFIX)))
        link = get(x, "link")
        url = F.concat(F.lit(WEIBO_HOST), F.substring_index(link, "ref=home", 1), F.lit("type=comment"))
        expanded = F.coalesce(get(x, "expand").try_cast("int"), F.lit(0)) > 0
        forwards, comments, likes = counters(get(x, "ems"))
        return _item(title, url, F.regexp_extract(get(x, "usercard"), r"id=([^&]*)", 1), url,
                     ts=fn.string_to_millis(get(x, "date"), dates.FMT_ACTION, zone), reposts=forwards,
                     comments=comments, likes=likes, keep=~expanded, valid=expanded | link.contains(PERMALINK_MARK))

    return (F.when(platform_id == 40002, F.transform(raw, listed)).when(platform_id == 40003, F.transform(raw, tabled))
            .when(platform_id == 40005, F.transform(raw, card)))


def items(platform_id: Column, page_url: Column, html: Column) -> Column:
    """The page's item array; empty for a page that cannot be read."""
    found = (F.when(platform_id == 40001, status_items(html)).when(platform_id == 40004, action_items(html))
             .otherwise(html_items(platform_id, page_url, html)))
    return F.coalesce(found, F.array().cast(f"array<{ITEM}>"))


def newest(kind: Column, found: Column) -> Column:
    """The marker a page leaves behind (NULL for a page without items)."""
    first = F.try_element_at(found, F.lit(1))
    by_time = F.array_max(F.transform(found, lambda x, i: F.struct(x["ts"].alias("ts"), (-i).alias("i"),
                                                                   x["key"].alias("key"))))
    return (F.when(kind == "ts", first["ts"].cast("string")).when(kind == "head", by_time["key"])
            .otherwise(first["key"]))


def next_marker(kind: Column, last: Column, new: Column) -> Column:
    """The marker after a page: a time marker never goes back."""
    later = F.greatest(last.try_cast("bigint"), new.try_cast("bigint")).cast("string")
    return F.when(kind == "ts", later).otherwise(F.coalesce(new, last))


def unseen(kind: Column, found: Column, last: Column) -> Column:
    """The items of a page that are new against its marker, before ``keep``."""
    since = F.coalesce(last.try_cast("bigint"), F.lit(0))
    return (F.when(kind == "ts", increments.take_while_array(found, lambda x: x["ts"] > since))
            .when(kind == "head", F.when(newest(kind, found).eqNullSafe(last), F.slice(found, 1, 0))
                  .otherwise(increments.take_while_array(found, lambda x: x["valid"])))
            .otherwise(increments.take_until_seen_array(found, "key", last)))
