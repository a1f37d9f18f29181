"""Extraction of ordered items, article bodies and profile fields from page
text with built-in expressions (regex, JSON, higher-order functions).

Every extractor is Column-valued: it runs inside whole-stage codegen right
after the page lookup, and the html column is dropped before anything is
shuffled. Class-scoped nested HTML that regexes cannot express goes through
``html_blocks`` (one ``mapInPandas`` walker, see ``html_walk``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Patterns for the list pages (navigation lists: <li><a href="..">text</a>).
LI_HREF = r'<li><a href="([^"]*)">'
LI_TEXT = r'<li><a href="[^"]*">([^<]*)</a>'
LI_ITEM = r'<li><a href="([^"]*)">([^<]*)</a>'   # a row is matched once, whole
TITLE = r"<title>([^<]*)</title>"
H1 = r"<h1>([^<]*)</h1>"
PARA = r"<p>(.*?)</p>"
SCRIPT = r"<script>(.*?)</script>"
ORIGIN = r"^(https?://[^/?#]+)"


def list_items(html) -> Column:
    """FEED1 item array: ``array<struct<href, text>>`` in page order."""
    return F.transform(F.regexp_extract_all(_c(html), F.lit(LI_ITEM), 0), lambda x: F.struct(
        F.regexp_extract(x, LI_ITEM, 1).alias("href"), F.regexp_extract(x, LI_ITEM, 2).alias("text")))


def origin(url) -> Column:
    return F.regexp_extract(_c(url), ORIGIN, 1)


def absolute(page_url, href) -> Column:
    """Site-relative href -> absolute url on the page's origin."""
    h = _c(href)
    return F.when(h.startswith("/"), F.concat(origin(page_url), h)).otherwise(h)


def explode_items(df: DataFrame, arr: Column, keep: list[str], pos: str = "pos",
                  item: str = "item") -> DataFrame:
    """``posexplode`` an item array, keeping only ``keep`` columns (so the
    html is not carried past this point)."""
    return df.select(*keep, F.posexplode(arr).alias(pos, item))


def title(html) -> Column:
    return F.regexp_extract(_c(html), TITLE, 1)


def paragraphs(html) -> Column:
    return F.regexp_extract_all(_c(html), F.lit(PARA), 1)


def text_of(html_fragment) -> Column:
    """Tags stripped, whitespace kept (ART8 applied to a fragment)."""
    return F.regexp_replace(_c(html_fragment), "<[^>]*>", "")


# Markers around the status JSON embedded in 40001 pages.
STATUS_START = "SNB.data.statuses = "
STATUS_END = ";\n  SNB.data.statusType"
PROFILE_START = "SNB.profileUser ="
PROFILE_END = "</script>"


def between(text, start: str, end: str) -> Column:
    """SRC10: text between the first ``start`` and the next ``end`` (NULL when
    ``start`` is absent); literal markers, no regex."""
    t = _c(text)
    after = F.substring_index(t, start, -1)
    return F.when(F.instr(t, start) > 0, F.substring_index(after, end, 1))


def last_script_with(html, marker: str) -> Column:
    """SRC8: the last ``<script>`` body containing ``marker`` (NULL if none)."""
    scripts = F.regexp_extract_all(_c(html), F.lit(r"(?s)<script[^>]*>(.*?)</script>"), 1)
    return F.try_element_at(F.filter(scripts, lambda s: s.contains(marker)), F.lit(-1))


def island(html, call: str) -> Column:
    """SRC9: the JSON argument of ``call(..)`` that fills a script; the first such script."""
    scripts = F.regexp_extract_all(_c(html), F.lit(r"(?s)<script[^>]*>(.*?)</script>"), 1)
    first = F.trim(F.try_element_at(F.filter(scripts, lambda s: F.trim(s).startswith(call + "(")), F.lit(1)))
    return F.regexp_extract(first, r"(?s)^[^(]*\((.*)\)\s*;?\s*$", 1)


def status_doc(html) -> Column:
    """40001 page -> ``{"statuses": [...]}`` JSON text from its script."""
    return F.concat(F.lit('{"statuses":'),
                    between(last_script_with(html, STATUS_START), STATUS_START, STATUS_END), F.lit("}"))


def list_page_count(html: Column) -> Column:
    """The number of list pages from the label of the first one (after its first two
    characters); 1 without a label."""
    label = F.trim(F.regexp_extract(html, r'class="CoRed"[^>]*>([^<]*)<', 1))
    return F.coalesce(F.substring(label, 3, 20).try_cast("int"), F.lit(1))


def status_text(html: Column) -> Column:
    """The status document of a 40001 home page: what the last script that holds it
    assigns, without the closing ';'."""
    mark = F.lit(STATUS_START.strip())
    script = last_script_with(html, STATUS_START.strip())
    body = F.split_part(F.split_part(script, F.lit("SNB.data.statusType ="), F.lit(1)), mark, F.lit(2))
    return F.regexp_replace(F.trim(body), r";\s*$", "")
