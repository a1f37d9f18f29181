"""Flagship: feed increments.

notices -> parse/reject -> route by platform -> page lookup -> the platform's own
extractor -> only what is newer than the page's marker, by the platform's own
rule -> article rows + tasks.

This is the batch form over a whole notice table with a stored marker
table. ``feedlake.streaming.feed`` runs the same steps as a stream, with the
marker kept as keyed state (snapshots of one page applied in arrival order).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import lookup, messages
from ..operators import platform_items as pi
from ..operators.keyed_tables import KeyedLog
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import standins

MARKER_SCHEMA = "page_url string, last_key string"
BEFORE_FIRST_RUN = -1


def with_items(hits: DataFrame, keep: list[str]) -> DataFrame:
    """Found pages -> ``keep`` columns, the item array and the marker the page
    leaves (``newest``); the html column ends here."""
    found = hits.select(*keep, pi.items(F.col("platform_id"), F.col("page_url"), F.col("page_html")).alias("items"))
    return found.withColumn("newest", pi.newest(F.col("marker_kind"), F.col("items")))


def notices_to_pages(notices: DataFrame, store: DataFrame, platforms: DataFrame,
                     buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> (pages, rejects, misses). ``pages`` has one row per announced page
    with its ordered item array and no html column. ``buckets``: of a store that is
    a bucketed table; its html is then not shuffled."""
    good, rejects = messages.parse(notices)
    routed, unknown = messages.route(good, platforms)
    # A page announced twice is looked up once, for its first notice: the store
    # holds one version per key, so the repeat would find every item seen.
    first = F.min(F.struct("msg_seq", "platform_id", "marker_kind", "needs_login")).alias("f")
    requests = routed.groupBy("key_name", "pos_name").agg(first).select("key_name", "pos_name", "f.*")
    looked = lookup.lookup(requests, store, buckets=buckets)
    hits, misses = lookup.split_hits(looked, lookup.MISS_NULL_OR_EMPTY)
    pages = with_items(hits, ["platform_id", "marker_kind", "needs_login", "page_url"])
    all_rejects = rejects.select("msg_seq", "value", "reason").unionByName(
        unknown.select("msg_seq", "value", "reason"))
    miss_rows = misses.select("msg_seq", "platform_id", "key_name", "pos_name")
    return pages, all_rejects, miss_rows


def earlier_markers(pages: DataFrame, keep: tuple = ()) -> DataFrame:
    """Marker table ``(kept columns, page_url, last_key)`` as left by an earlier crawl of pages
    (``page_id, marker_kind, page_url, items, newest``): page_id%4 = 0 -> the 3rd item,
    1 -> the newest item (nothing new), 2 -> no marker, 3 -> a key no longer on the page."""
    k = F.col("page_id") % 4
    third = F.try_element_at("items", F.lit(3))
    by_kind = F.when(F.col("marker_kind") == "ts", third["ts"].cast("string")).otherwise(third["key"])
    gone = F.when(F.col("marker_kind") == "ts", F.lit("1")).otherwise(F.lit("gone"))
    return pages.where(k != 2).select(*keep, "page_url", F.when(k == 0, by_kind).when(k == 1, F.col("newest")).otherwise(gone)
                                      .alias("last_key"))


def page_markers(spark: SparkSession, d: str, keep: tuple = ()) -> DataFrame:
    """``earlier_markers`` of all stored pages."""
    s = (standins.feed_store(spark, d).where("html <> ''").withColumnRenamed("url", "page_url")
         .withColumnRenamed("html", "page_html")
         .join(F.broadcast(schemas.platforms(spark).select("platform_id", "marker_kind")), "platform_id"))
    return earlier_markers(with_items(s, [*keep, "page_id", "marker_kind", "page_url"]), keep)


def unseen_items(pages: DataFrame) -> DataFrame:
    """Pages with ``items`` and their marker ``last_key`` -> one row per new
    article item, with its place on the page."""
    kept = pi.unseen(F.col("marker_kind"), F.col("items"), F.col("last_key"))
    return (pages.select("platform_id", "needs_login", "page_url", F.posexplode(kept).alias("pos", "it"))
            .where("it.keep"))


def new_items(pages: DataFrame, markers: DataFrame) -> DataFrame:
    """One join with the marker table; the walk itself is inside each row."""
    return unseen_items(pages.join(markers.select("page_url", "last_key"), "page_url", "left"))


def article_rows(new: DataFrame) -> DataFrame:
    """One row per article: an article listed on several pages is taken from
    the first page by address."""
    rows = new.select("platform_id", F.col("it.url").alias("url"), "page_url", F.col("pos").cast("int").alias("pos"),
                      F.col("it.user_id").alias("user_id"), F.col("it.title").alias("title"), F.col("it.ts").alias("ts"),
                      *[F.col(f"it.{c}").alias(c) for c in ("reposts", "comments", "likes")],
                      messages.article_task("platform_id", F.col("it.url"), F.col("needs_login")).alias("task"))
    rest = [c for c in rows.columns if c not in ("platform_id", "url")]
    return rows.groupBy("platform_id", "url").agg(F.min(F.struct(*rest)).alias("f")).select("platform_id", "url", "f.*")


def feed_increments(spark: SparkSession, d: str) -> DataFrame:
    """Each announced page is found and walked once: its items are written and read
    for the markers of the earlier crawl and for what is new."""
    store = standins.feed_store(spark, d)
    pages, _, _ = notices_to_pages(standins.messages(spark, d, store), store, schemas.platforms(spark))
    path = scratch_path(spark, "flagship-pages")
    pages.write.parquet(path)
    pages = spark.read.schema(pages.schema).parquet(path)
    ids = store.select("page_id", F.col("url").alias("page_url"))
    return article_rows(new_items(pages, earlier_markers(pages.join(ids, "page_url"))))


# ---------------------------------------------------------------------------
# Scheduled batch runs. Markers and written addresses are keyed logs by run
# (``operators.keyed_tables``): a run reads, of its own pages' buckets, the newest
# marker written *before* its id, so re-running an id overwrites its own folders
# with the same content, and opens a bounded number of folders however many runs
# there were. articles/run=<id>, tasks/run=<id>, rejects/run=<id> are its output.
# ---------------------------------------------------------------------------
def marker_log(spark: SparkSession, root: str, **kw) -> KeyedLog:
    return KeyedLog(spark, f"{root}/markers", {"page_url": "string"}, {"last_key": "string"}, **kw)


def article_log(spark: SparkSession, root: str, **kw) -> KeyedLog:
    return KeyedLog(spark, f"{root}/written", {"platform_id": "int", "url": "string"}, **kw)


def next_markers(pages: DataFrame, markers: DataFrame) -> DataFrame:
    """Markers that a run changes: only pages seen in it."""
    j = (pages.select("page_url", "marker_kind", "newest")
         .join(markers.select("page_url", F.col("last_key").alias("old")), "page_url", "left"))
    new = pi.next_marker(F.col("marker_kind"), F.col("old"), F.col("newest"))
    return j.select("page_url", new.alias("last_key"), "old").where(
        ~F.col("last_key").eqNullSafe(F.col("old"))).drop("old")


def run_increment(spark: SparkSession, notices: DataFrame, store: DataFrame, platforms: DataFrame,
                  root: str, run_id: int, initial_markers: DataFrame | None = None, buckets: int | None = None) -> None:
    ensure_checkpoint_dir(spark)
    pages, rejects, _ = notices_to_pages(notices, store, platforms, buckets)
    pages = pages.checkpoint(eager=True)    # read twice below; html already dropped
    log, written_log = marker_log(spark, root), article_log(spark, root)
    if initial_markers is not None:   # from before the first run (ids count from 0)
        log.write(initial_markers, BEFORE_FIRST_RUN)
    markers = log.state(run_id, pages)
    rows = article_rows(new_items(pages, markers)).checkpoint(eager=True)
    written_log.absent(rows, run_id).write.mode("overwrite").parquet(f"{root}/articles/run={run_id}")
    written = spark.read.schema(rows.schema).parquet(f"{root}/articles/run={run_id}")
    written_log.write(written.select("platform_id", "url"), run_id)
    written.select(F.col("task").alias("value")).write.mode("overwrite").text(f"{root}/tasks/run={run_id}")
    rejects.write.mode("overwrite").parquet(f"{root}/rejects/run={run_id}")
    log.write(next_markers(pages, markers), run_id)
