"""Item extraction from the platforms' class-scoped HTML pages.

One Arrow walker (standard-library ``html.parser``) driven by a
per-platform spec: an item block selected by tag and classes (optionally
inside an ancestor with a class), and named fields inside each item taken
as text, an attribute, a count or a list, by occurrence. The walker emits
``(id, pos, fields MAP<STRING,STRING>)`` rows; everything after that (ids
from urls, counter parsing, ordering rules, marker logic) is Spark
expressions. Page order is kept in ``pos``; cover cards come first.
"""
from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates
from ..functions.urls import after_marker, last_segment
from ..session import bound_batches, once
from . import messages

SELF = "."
VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "wbr"}

# ---------------------------------------------------------------------------
# The platforms' page structure (tags and class names).
# item: (tag or None, required classes, inside-class); "first": only items inside the
#   first element of the inside-class
# field: (tag, required classes, mode, attribute, occurrence, inside-class); tag SELF: the
#   item itself (text or attr); mode: text | attr | count | list; occurrence -1 of an
#   attribute: the last
# ---------------------------------------------------------------------------
SPECS = {
    40002: {
        "item": ("li", (), "TabItem"),
        "fields": {
            "title": ("a", ("Tit",), "text", None, 0, "UserBox"),
            "url": ("a", ("Tit",), "attr", "href", 0, "UserBox"),
            "author": ("a", ("Name",), "attr", "href", 0, "UserBox"),
            "badges": ("i", ("TuiJian",), "count", None, 0, "UserBox"),
            "reproduce": ("span", (), "text", None, 1, "HandleBox"),
            "comment": ("span", (), "text", None, 2, "HandleBox"),
        },
    },
    40003: {
        "item": ("tr", (), "blu authortab-list"),
        "fields": {
            "title": ("a", (), "text", None, 0, None),
            "href": ("a", (), "attr", "href", 0, None),
        },
    },
    40005: {
        "item": ("div", ("WB_cardwrap", "WB_feed_type", "S_bg2"), None),
        "cover_class": "WB_feed_vipcover",
        "fields": {
            "expand": ("div", ("WB_feed_expand",), "count", None, 0, None),
            "date": ("a", (), "attr", "title", 0, "WB_from S_txt2"),
            "link": ("a", (), "attr", "href", 0, "WB_from S_txt2"),
            "headline": ("h4", (), "text", None, 0, "WB_feed_spec_cont"),
            "user": ("a", ("W_f14", "W_fb", "S_txt1"), "text", None, 0, None),
            "user_alt": ("a", ("W_fb", "S_txt1"), "text", None, 0, None),
            "usercard": ("a", ("W_f14", "W_fb", "S_txt1"), "attr", "usercard", 0, None),
            "ems": ("em", (), "list", None, 0, "WB_feed_handle"),
        },
    },
}
# Profile page structure (one item = the whole page).
PROFILE_SPECS = {
    40002: {
        "item": ("html", (), None),
        "fields": {
            "name": ("strong", (), "text", None, 0, "BloggerName"),
            "intro": (None, ("#BlogNameLoad",), "text", None, 0, None),
            "badges": (None, ("ApproveIco",), "count", None, 0, None),
            "portrait": ("img", (), "attr", "src", 0, "BloggerPic"),
        },
    },
    40003: {
        "item": ("html", (), None),
        "fields": {
            "portrait": ("img", (), "attr", "src", 0, "author-avatar"),
            "name": ("span", (), "text", None, 0, "author-msg"),
            "field": ("span", (), "text", None, 0, ("author-msg", "<p")),
            "blue": (None, ("moerv-blue",), "count", None, 0, None),
            "red": (None, ("moerv-red",), "count", None, 0, None),
            "fans": (None, ("#fansCount",), "text", None, 0, None),
            "intro": ("tr", (), "text", None, 3, "anthor_left_bottom"),
        },
    },
}
MOER_HOST, WEIBO_HOST, PERMALINK_MARK = schemas.MOER_HOST, schemas.WEIBO_HOST, schemas.PERMALINK_MARK


def _classes(attrs) -> set[str]:
    return set((dict(attrs).get("class") or "").split())


def _has(cls: set[str], needed, attrs: dict) -> bool:
    """``needed``: class names, ``#id`` entries matched against the id, and ``[name]``
    or ``[name=value]`` entries against the other attributes."""
    if needed is None:
        return True
    for n in needed.split() if isinstance(needed, str) else needed:
        if n.startswith("#"):
            if attrs.get("id") != n[1:]:
                return False
        elif n.startswith("["):
            name, eq, value = n[1:-1].partition("=")
            if name not in attrs or (eq and attrs[name] != value):
                return False
        elif n not in cls:
            return False
    return True


def _conds(within) -> list[str]:
    return [] if within is None else [within] if isinstance(within, str) else list(within)


def _cond_ok(cond: str, tag: str, cls: set[str], el_id: str | None) -> bool:
    """Ancestor condition: ``<tag``, ``#id`` or a class set."""
    if cond.startswith("<"):
        return tag == cond[1:]
    if cond.startswith("#"):
        return el_id == cond[1:]
    return set(cond.split()) <= cls


class _ItemWalker(HTMLParser):
    def __init__(self, spec):
        super().__init__(convert_charrefs=True)
        self.item_tag, self.item_classes, self.item_within = spec["item"]
        self.fields = spec["fields"]
        self.cover_class = spec.get("cover_class")
        self.first_area, self.areas = spec.get("first", False), 0
        self.stack = []          # (tag, classes, [capture ids])
        self.item_depth = None
        self.cur = None
        self.counts = None
        self.caps = {}           # capture id -> [field, parts]
        self.items = []
        self._cid = 0

    def _inside(self, within, from_depth=0):
        """Every condition is met by some open ancestor (from ``from_depth``)."""
        scope = self.stack[from_depth:]
        return all(any(_cond_ok(c, t, k, i) for t, k, i, _ in scope) for c in _conds(within))

    def _opens_area(self, tag, cls, el_id):
        """The element is the innermost one the items' place asks for, in no other such."""
        *outer, last = _conds(self.item_within)
        return _cond_ok(last, tag, cls, el_id) and self._inside(outer) and not self._inside(self.item_within)

    def handle_starttag(self, tag, attrs):
        cls = _classes(attrs)
        a = dict(attrs)
        el_id = a.get("id")
        opened = []
        if self.item_depth is None:
            if self.first_area and self._opens_area(tag, cls, el_id):
                self.areas += 1
            if (self.item_tag is None or tag == self.item_tag) and _has(cls, self.item_classes, a) \
                    and self._inside(self.item_within) and (not self.first_area or self.areas == 1):
                self.item_depth = len(self.stack)
                self.cur = {"_cover": "1" if self.cover_class and self.cover_class in cls else "0"}
                self.counts = {}
                for name, (ftag, _, mode, attr, _, _) in self.fields.items():
                    if ftag == SELF and mode == "text":
                        opened.append(self._open_cap(name))
                    elif ftag == SELF and a.get(attr) is not None:
                        self.cur[name] = a[attr]
                if tag in VOID:
                    for c in opened:
                        self._close_cap(c)
                    self._emit()
                    return
        else:
            for name, (ftag, fcls, mode, attr, nth, within) in self.fields.items():
                if (ftag is not None and tag != ftag) or not _has(cls, fcls, a) \
                        or not self._inside(within, self.item_depth):
                    continue
                k = self.counts.get(name, 0)
                self.counts[name] = k + 1
                if mode == "count":
                    self.cur[name] = str(k + 1)
                elif mode == "attr" and nth in (k, -1):
                    self.cur[name] = a.get(attr) or ""
                elif (mode == "text" and k == nth) or mode == "list":
                    opened.append(self._open_cap(name))
        if tag in VOID:
            for c in opened:
                self._close_cap(c)
            return
        self.stack.append((tag, cls, el_id, opened))

    def handle_data(self, data):
        for _, parts in self.caps.values():
            parts.append(data)

    def _open_cap(self, name) -> int:
        self._cid += 1
        self.caps[self._cid] = [name, []]
        return self._cid

    def _close_cap(self, c):
        name, parts = self.caps.pop(c)
        text = "".join(parts).strip()
        if self.fields[name][2] == "list":
            self.cur.setdefault("_list_" + name, []).append(text)
        else:
            self.cur[name] = text

    def handle_endtag(self, tag):
        for j in range(len(self.stack) - 1, -1, -1):
            if self.stack[j][0] == tag:
                for _, _, _, opened in reversed(self.stack[j:]):
                    for c in opened:
                        self._close_cap(c)
                del self.stack[j:]
                if self.item_depth is not None and j <= self.item_depth:
                    self._emit()
                return

    def _emit(self):
        for c in list(self.caps):
            self._close_cap(c)
        item = {k: v for k, v in self.cur.items() if not k.startswith("_list_")}
        for k, v in self.cur.items():
            if k.startswith("_list_"):
                item[k[len("_list_"):]] = json.dumps(v, ensure_ascii=False)
        self.items.append(item)
        self.item_depth, self.cur, self.counts = None, None, None

    def finish(self):
        if self.item_depth is not None:
            self._emit()
        # cover cards first, each group in page order
        return sorted(self.items, key=lambda it: it.get("_cover") != "1")


def _items(spec, html: str | None) -> list:
    w = _ItemWalker(spec)
    try:
        w.feed(html or "")
        w.close()
    except AssertionError:  # the parser's answer to a broken declaration: keep what was found
        pass
    return w.finish()


class _AreaWalker(HTMLParser):
    """Several item specs in one pass over a page."""
    def __init__(self, specs):
        super().__init__(convert_charrefs=True)
        self.walkers = [_ItemWalker(s) for s in specs]

    def handle_starttag(self, tag, attrs):
        for w in self.walkers:
            w.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for w in self.walkers:
            w.handle_endtag(tag)

    def handle_data(self, data):
        for w in self.walkers:
            w.handle_data(data)


def area_items(specs: list, html: str | None) -> list:
    """(number of the spec, place among its items, raw fields) of all items of a page."""
    w = _AreaWalker(specs)
    try:
        w.feed(html or "")
        w.close()
    except AssertionError:  # as in _items
        pass
    return [(n, i, x) for n, one in enumerate(w.walkers) for i, x in enumerate(one.finish())]


def walked_areas(html: Column, specs: list) -> Column:
    """Array of (area, pos, fields) of a page walked once for several item specs."""
    fields = pa.map_(pa.string(), pa.string())
    out = pa.list_(pa.struct([("area", pa.int32()), ("pos", pa.int32()), ("fields", fields)]))

    @F.arrow_udf("array<struct<area: int, pos: int, fields: map<string,string>>>")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([[{"area": n, "pos": i, "fields": list(x.items())} for n, i, x in area_items(specs, h.as_py())]
                         for h in pages], out)

    return once(run)(html)


def items_of(platform_id: int | None, html: str | None) -> list:
    """Raw item fields of one page; none for a platform without an HTML feed."""
    spec = SPECS.get(platform_id)
    return _items(spec, html) if spec else []


def walked(html: Column, spec: dict) -> Column:
    """Array of the raw fields of each item of a page, in page order."""

    @F.arrow_udf("array<map<string,string>>")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([[list(x.items()) for x in _items(spec, h.as_py())] for h in pages],
                        pa.list_(pa.map_(pa.string(), pa.string())))

    return once(run)(html)


def page_items(pages: DataFrame, platform_id: int, id_col: str = "page_id", html_col: str = "html",
               specs: dict | None = None, keep: tuple = ()) -> DataFrame:
    """(id, kept columns, pos, fields) per item of each page, for one platform's spec.
    Every row of ``pages`` is a page of its own, also when ids repeat; the html ends
    here. Pages go to Python in batches of bounded bytes."""
    bound_batches(pages.sparkSession)
    return pages.select(F.col(id_col).cast("long").alias("id"), *keep,
                        F.posexplode(walked(F.col(html_col).cast("string"), (specs or SPECS)[platform_id])).alias("pos", "fields"))


def profile_40002(items: DataFrame, page_url: Column) -> DataFrame:
    """PROF1: id = page url after its first 22 chars; name; trimmed intro; vip = any
    approval badge."""
    return items.select("id", F.substring(page_url, 23, 1 << 20).alias("user_id"), _f("name").alias("name"),
                        F.trim(_f("intro")).alias("introduction"),
                        (F.coalesce(_f("badges").cast("int"), F.lit(0)) > 0).alias("vip"))


def profile_40003(items: DataFrame, page_url: Column) -> DataFrame:
    """PROF4: portrait, name, vip 0/1/2 (red beats blue), field, fans,
    intro; a page whose fan count does not parse is a recrawl (result 0),
    else acknowledged (result 1)."""
    fans = F.trim(_f("fans")).try_cast("int")
    vip = (F.when(F.coalesce(_f("red").cast("int"), F.lit(0)) > 0, 2)
           .when(F.coalesce(_f("blue").cast("int"), F.lit(0)) > 0, 1).otherwise(0))
    return items.select("id", after_marker(page_url, "theId=").alias("user_id"), _f("portrait").alias("portrait"),
                        F.trim(_f("name")).alias("name"), vip.alias("vip"), F.trim(_f("field")).alias("field"),
                        fans.alias("followers_count"), F.trim(_f("intro")).alias("introduction"),
                        F.when(fans.isNull(), 0).otherwise(1).alias("result"))


# The two documents of a 40005 home page and what their html holds.
HEAD_START, COUNT_START = '{"ns":"pl.header.head.index"', '{"ns":"","domid":"Pl_Core_T8CustomTriColumn__3"'
VERIFIED_MARK = "key=profile_head&value=vuser_guest"
HEAD_40005 = [{"item": (None, ("username",), None), "fields": {"text": (SELF, (), "text", None, 0, None)}},
              {"item": ("img", (), None), "fields": {"src": (SELF, (), "attr", "src", 0, None)}},
              {"item": (None, ("pf_intro",), None), "fields": {"text": (SELF, (), "text", None, 0, None)}}]
COUNT_40005 = [{"item": ("td", (), None), "fields": {"n": ("strong", (), "text", None, 0, None)}}]


def _first(areas: str, area: int, field: str, pos: int = 0) -> Column:
    """A field of one item of walked areas: '' when the item lacks it, NULL without the item."""
    item = F.get(F.filter(areas, lambda x: (x["area"] == area) & (x["pos"] == pos)), F.lit(0))
    return F.when(item.isNotNull(), F.coalesce(F.try_element_at(item["fields"], F.lit(field)), F.lit("")))


def profiles_40005(pages: DataFrame) -> DataFrame:
    """PROF9: ``pages(page_url, html)`` -> user id (last part of the address), name,
    portrait, introduction and verified mark from the html inside the page's head
    document, followers from the second cell inside its counter document. A page that
    lacks a document or one of these parts gives only its recrawl task (2); a portrait
    without address is ''."""
    bound_batches(pages.sparkSession)
    script = rf"(?s){re.escape(schemas.SCRIPT_HEAD)}(.*?){re.escape(schemas.SCRIPT_TAIL)}"
    docs = F.regexp_extract_all(F.col("html").cast("string"), F.lit(script), 1)

    def inner(start: str) -> Column:
        doc = F.get(F.filter("docs", lambda s: s.startswith(start)), F.lit(0))
        return F.try_variant_get(F.try_parse_json(doc), "$.html", "string")

    read = pages.select("page_url", docs.alias("docs"))
    read = read.select("page_url", inner(HEAD_START).alias("head"), inner(COUNT_START).alias("counts"))
    read = read.select("page_url", F.col("head").contains(VERIFIED_MARK).alias("vip"),
                       walked_areas(F.col("head"), HEAD_40005).alias("h"), walked_areas(F.col("counts"), COUNT_40005).alias("c"))
    text = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    row = read.select("page_url", "vip", text(_first("h", 0, "text")).alias("name"), _first("h", 1, "src").alias("portrait"),
                      text(_first("h", 2, "text")).alias("introduction"),
                      F.trim(_first("c", 0, "n", 1)).try_cast("int").alias("followers_count"))
    parts = ["name", "portrait", "introduction", "followers_count", "vip"]
    bad = F.exists(F.array(*[F.col(c).isNull() for c in parts]), lambda x: x)
    return row.select("page_url", F.when(~bad, last_segment("page_url")).alias("user_id"),
                      *[F.when(~bad, F.col(c)).alias(c) for c in parts],
                      F.when(bad, messages.crawl_task(F.lit(40005), "page_url", schemas.RESULT_RECRAWL)).alias("task"))


def _f(name: str) -> Column:
    return F.element_at(F.col("fields"), F.lit(name))


def last_token_int(text: Column) -> Column:
    return F.element_at(F.split(F.trim(text), " "), -1).try_cast("int")


def list_items_40002(items: DataFrame) -> DataFrame:
    """FEED1: title, url, user id (last path part of the author link),
    recommend (badge count), repost / comment (last token of the 2nd / 3rd
    handle span)."""
    return items.select("id", "pos", _f("title").alias("title"), _f("url").alias("url"),
                        last_segment(_f("author")).alias("user_id"),
                        F.coalesce(_f("badges").cast("int"), F.lit(0)).alias("recommend"),
                        last_token_int(_f("reproduce")).alias("reproduce"),
                        last_token_int(_f("comment")).alias("comment"))


def table_items_40003(items: DataFrame, page_url: Column) -> DataFrame:
    """FEED2: title and link of the first anchor; user id = ``theId`` of the
    page url; read, buy and price 0; absolute url."""
    return items.select("id", "pos", _f("title").alias("title"),
                        F.concat(F.lit(MOER_HOST), _f("href")).alias("url"),
                        after_marker(page_url, "theId=").alias("user_id"),
                        F.lit(0).alias("read_count"), F.lit(0).alias("buy_count"), F.lit(0.0).alias("price"))


def counter(ems, idx: int, label: str, shift_idx: int | None = None) -> Column:
    """FEED6b: cell ``idx`` (0-based) as an int; too few cells or the bare
    label -> 0; a shift marker moves to the next cell."""
    cell = F.get(ems, F.lit(idx))
    if shift_idx is not None:
        cell = F.when(F.trim(cell) == schemas.SHIFT_MARK, F.get(ems, F.lit(shift_idx))).otherwise(cell)
    return (F.when(F.size(ems) < idx + 1, F.lit(0))
            .when(F.coalesce(cell, F.lit("")).startswith(label), F.lit(0))
            .otherwise(F.trim(cell).try_cast("int")))


def counters(ems_json: Column) -> tuple[Column, Column, Column]:
    """Forwards, comments and likes of a card from its handle cells."""
    ems = F.coalesce(F.from_json(ems_json, "array<string>"), F.array().cast("array<string>"))
    return (counter(ems, 3, schemas.LABEL_FORWARD), counter(ems, 5, schemas.LABEL_COMMENT, shift_idx=6),
            counter(ems, 7, schemas.LABEL_LIKE))


def cards_40005(items: DataFrame, zone: str = "Asia/Shanghai") -> DataFrame:
    """FEED6: covers first, then normal cards; cards with an expand block are
    skipped; permalink = link before 'ref=home' + 'type=comment' on the site
    host (``has_permalink`` false stops the walk, INC4); ts from the link
    title; user id from ``usercard`` (``id=..&``); title = headline, else
    author + suffix; counters by em position (FEED6b)."""
    forwards, comments, likes = counters(_f("ems"))
    user = F.coalesce(F.nullif(_f("user"), F.lit("")), _f("user_alt"))
    title = F.coalesce(F.nullif(_f("headline"), F.lit("")), F.concat(user, F.lit(schemas.TITLE_SUFFIX)))
    link = _f("link")
    kept = items.where(F.coalesce(_f("expand").cast("int"), F.lit(0)) == 0)
    return kept.select(
        "id", "pos", (_f("_cover") == "1").alias("is_cover"),
        F.coalesce(link.contains(PERMALINK_MARK), F.lit(False)).alias("has_permalink"),
        F.concat(F.lit(WEIBO_HOST), F.substring_index(link, "ref=home", 1), F.lit("type=comment")).alias("url"),
        F.regexp_extract(_f("usercard"), r"id=([^&]*)", 1).alias("user_id"),
        title.alias("title"),
        _to_ms(_f("date"), zone).alias("ts_ms"),
        forwards.alias("forwards"), comments.alias("comments"), likes.alias("likes"))


def _to_ms(text: Column, zone: str) -> Column:
    from ..functions.dates import string_to_millis
    return string_to_millis(text, dates.FMT_ACTION, zone)
