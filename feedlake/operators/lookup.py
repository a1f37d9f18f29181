"""Page lookups against the raw-page table (SRC2-SRC4, MSG4, MSG7).

The reference does one key-value ``Get`` per message. Here the lookup is a
left join on ``(table_name, row_key)``: Catalyst picks broadcast-hash when
the request side is small (AQE re-plans at runtime from the real size) and
sort-merge otherwise. Only key columns and the html needed by the caller
cross the shuffle; extraction happens right after the join and html is
dropped before any further grouping.

A store that is a bucketed table (``sources.page_store.write_bucketed``) is not
shuffled at all: with ``buckets`` the distinct requests are dealt to its buckets
and are the hashed side of the join, so pages are read, matched and extracted in
the task that scans them and are neither moved nor sorted.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import splittable_join

MISS_NULL = "null"              # miss = no row / NULL cell (40005 rule)
MISS_NULL_OR_EMPTY = "null_or_empty"   # miss also when url or content is ''


def lookup(requests: DataFrame, store: DataFrame, table_col: str = "key_name",
           key_col: str = "pos_name", content_cols: tuple[str, ...] = ("url", "html"),
           prefix: str = "page_", buckets: int | None = None) -> DataFrame:
    """SRC2: left join; adds ``page_url`` / ``page_html`` (NULL on miss).
    Both cells must be present, else the whole result is NULL (reference:
    one NULL cell ends as a NULL result). With ``buckets`` (of a bucketed store)
    requests should not repeat a key many times: a bucket's are held in memory."""
    if buckets:
        requests = dealt(requests, [table_col, key_col], buckets)
    s = store.select(F.col("table_name").alias("_t"), F.col("row_key").alias("_k"),
                     *[F.col(c).alias(prefix + c) for c in content_cols])
    j = requests.join(s, (F.col(table_col) == F.col("_t")) & (F.col(key_col) == F.col("_k")), "left")
    all_present = None
    for c in content_cols:
        cond = F.col(prefix + c).isNotNull()
        all_present = cond if all_present is None else (all_present & cond)
    return j.select(*requests.columns,
                    *[F.when(all_present, F.col(prefix + c)).alias(prefix + c) for c in content_cols])


def lookup_content(requests: DataFrame, store: DataFrame, table_col: str = "key_name",
                   key_col: str = "pos_name") -> DataFrame:
    """SRC3: content-only lookup (one cell)."""
    return lookup(requests, store, table_col, key_col, content_cols=("html",))


def lookup_by_url(requests: DataFrame, store: DataFrame, url_col: str = "url",
                  content_cols: tuple[str, ...] = ("html",), prefix: str = "page_") -> DataFrame:
    """Lookup when only the url is known (row key = url, any table)."""
    s = store.select(F.col("row_key").alias("_k"),
                     *[F.col(c).alias(prefix + c) for c in content_cols])
    j = requests.join(s, F.col(url_col) == F.col("_k"), "left").drop("_k")
    return j


def dealt(requests: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Requests in the buckets of the store, as the hashed side of the join to come."""
    return requests.repartition(buckets, *keys).hint("shuffle_hash")


def found_pages(requests: DataFrame, store: DataFrame, buckets: int | None = None, platform: str = "platform_id",
                url: str = "url") -> DataFrame:
    """``table_name, page_url, html`` of the stored pages that are asked for, each once."""
    asked = requests.select(F.col(platform).cast("string").alias("table_name"), F.col(url).alias("row_key")).distinct()
    if buckets:
        asked = dealt(asked, ["table_name", "row_key"], buckets)
    return asked.join(store.select("table_name", "row_key", "html"), ["table_name", "row_key"]).withColumnRenamed("row_key", "page_url")


def extracted(requests: DataFrame, store: DataFrame, extract: Callable[[DataFrame], DataFrame], buckets: int | None = None,
              platform: str = "platform_id", url: str = "url") -> DataFrame:
    """Requests with what ``extract`` makes of their pages (``table_name, page_url, html``
    -> the first two and narrow columns) and ``hit``: whether the page is stored. Only
    the narrow columns meet the requests, so a page asked for often is read once and a
    hot key can be split."""
    rows = extract(found_pages(requests, store, buckets, platform, url)).withColumn("hit", F.lit(True))
    rows = rows.withColumnsRenamed({"table_name": "_t", "page_url": "_u"})
    asked = requests.withColumns({"_t": F.col(platform).cast("string"), "_u": F.col(url)})
    return splittable_join(asked, rows, ["_t", "_u"], "left").drop("_t", "_u").na.fill(False, ["hit"])


def is_miss(rule: str = MISS_NULL_OR_EMPTY, url: str = "page_url", html: str = "page_html") -> Column:
    """MSG7 miss rules: NULL only, or NULL-or-empty."""
    m = F.col(html).isNull()
    if url is not None:
        m = m | F.col(url).isNull()
    if rule == MISS_NULL_OR_EMPTY:
        m = m | (F.col(html) == "")
        if url is not None:
            m = m | (F.col(url) == "")
    return m


def split_hits(looked_up: DataFrame, rule: str = MISS_NULL_OR_EMPTY, url: str | None = "page_url",
               html: str = "page_html") -> tuple[DataFrame, DataFrame]:
    """MSG7: one joined frame, two filters: ``(hits, misses)``."""
    m = is_miss(rule, url, html)
    return looked_up.where(~m), looked_up.where(m)


def decode_content(content) -> Column:
    """SRC4: bytes -> text; UTF-8 when valid, else GBK (needs
    ``spark.sql.legacy.javaCharsets=true``)."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")).otherwise(F.decode(c, "GBK"))
