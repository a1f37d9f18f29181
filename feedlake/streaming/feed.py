"""Flagship stream: notices -> parse / route -> stream-static page lookup ->
items by platform -> keyed marker state -> foreachBatch (write articles, then
tasks from what was written).

Delivery: the checkpoint commits source offsets and marker state together
with the batch; the sink writes each batch to its own folder
(``batch=<id>``, overwritten on replay), so a replayed batch yields the same
files and no duplicate tasks. Executor loss re-runs tasks; driver loss
restarts from the checkpoint.

``start`` joins each micro-batch with the page table as a stream-static
join, which reads the whole table per batch: right for a page table of
moderate size. For a page table at the 100 TB scale use
``start_two_stage``, whose lookup reads only the partitions of the batch's
keys (``sources.page_store`` layout).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lookup, messages, sinks
from ..operators import platform_items as pi
from ..operators.keyed_tables import KeyedLog
from ..plans.flagship import article_rows, unseen_items, with_items
from ..schemas import OWN_TOPIC
from ..sources import page_store as ps
from . import markers as mk

TRIGGER_SECONDS = 3   # fixed value: micro-batch interval


def snapshots(hits: DataFrame) -> DataFrame:
    """Found pages -> one row per page snapshot for the marker state."""
    keep = ["msg_seq", "platform_id", "marker_kind", "needs_login", "page_url"]
    pages = with_items(hits, keep).select(*keep, "newest", F.to_json("items").alias("payload"))
    return pages.select(*[F.col(f.name).cast(f.dataType) for f in mk.SNAPSHOT.fields])


def pages_stream(notices: DataFrame, store: DataFrame, platforms: DataFrame) -> DataFrame:
    """Stateless part: every notice -> its page's snapshot (stream-static joins)."""
    good, _ = messages.parse(notices)
    routed, _ = messages.route(good, platforms)
    looked = lookup.lookup(routed, store)
    hits, _ = lookup.split_hits(looked, lookup.MISS_NULL_OR_EMPTY)
    return snapshots(hits)


def rejects(notices: DataFrame, platforms: DataFrame) -> DataFrame:
    """Notices that cannot be routed, with the reason."""
    good, bad = messages.parse(notices)
    _, unknown = messages.route(good, platforms)
    return bad.select("value", "reason").unionByName(unknown.select("value", "reason"))


def new_items_stream(pages: DataFrame, seed_markers: DataFrame, ttl_ms: int) -> DataFrame:
    marked = mk.with_markers(pages, seed_markers, ttl_ms)
    return unseen_items(marked.withColumn("items", F.from_json("payload", f"array<{pi.ITEM}>")))


DAY_MS = 24 * 3600 * 1000


def written_articles(spark: SparkSession, out_dir: str) -> KeyedLog:
    """The addresses of all articles written, by micro-batch: a batch reads the
    buckets of its own addresses, of one snapshot and the batches after it."""
    return KeyedLog(spark, f"{out_dir}/written", {"platform_id": "int", "url": "string"})


def write_batch(out_dir: str, task_kafka: dict | None = None):
    """foreachBatch sink: articles first (those not yet written, SNK5), then their
    addresses, then tasks read back from the written files (SNK10 / SNK11 ordering).
    A replayed batch sees what it saw the first time and overwrites its own folders.
    Tasks land as text files, or go to Kafka when ``task_kafka`` holds the producer
    options (``kafka.bootstrap.servers``, ``topic`` and, for the platforms with a topic
    of their own, ``own_topic``); the clock id is stamped here."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = written_articles(spark, out_dir)
        rows = article_rows(batch).persist()   # asked for its buckets first, then written
        path = f"{out_dir}/articles/batch={batch_id}"
        log.absent(rows, batch_id).write.mode("overwrite").parquet(path)
        rows.unpersist()
        written = spark.read.schema(rows.schema).parquet(path)
        log.write(written.select("platform_id", "url"), batch_id)
        own = F.col("platform_id").isin(*OWN_TOPIC)
        if task_kafka:
            options = {k: v for k, v in task_kafka.items() if k not in ("topic", "own_topic")}
            topic = F.when(own, F.lit(task_kafka.get("own_topic", task_kafka["topic"]))).otherwise(task_kafka["topic"])
            (written.select(topic.alias("topic"), sinks.with_clock_id(F.col("task")).alias("value"))
             .write.format("kafka").options(**options).save())
        else:
            (written.select(F.when(own, "own").otherwise("common").alias("topic"), F.col("task").alias("value"))
             .write.mode("overwrite").partitionBy("topic").text(f"{out_dir}/tasks/batch={batch_id}"))
    return sink


def _trigger(writer, available_now: bool):
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=f"{TRIGGER_SECONDS} seconds"))


def start_rejects(notices: DataFrame, platforms: DataFrame, out_dir: str, checkpoint: str, available_now: bool = False):
    """A second query over the same source: rejected notices as a table."""
    return _trigger(rejects(notices, platforms).writeStream.format("parquet").option("path", f"{out_dir}/rejects")
                    .option("checkpointLocation", checkpoint), available_now).start()


def start(spark: SparkSession, notices: DataFrame, store: DataFrame, platforms: DataFrame,
          seed_markers: DataFrame, out_dir: str, checkpoint: str, available_now: bool = False,
          task_kafka: dict | None = None, ttl_days: float = mk.TTL_DAYS):
    new = new_items_stream(pages_stream(notices, store, platforms), seed_markers, int(ttl_days * DAY_MS))
    w = (new.writeStream.foreachBatch(write_batch(out_dir, task_kafka)).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    with mk.state_settings(spark):
        return _trigger(w, available_now).start()


# ---------------------------------------------------------------------------
# Two-stage layout for very large page stores.
#
# Stage A (stateless, foreachBatch): notices -> parse / route -> lookup that
# reads only the store partitions of the batch's keys -> page snapshots, written
# to a table (one folder per batch id, overwritten on replay).
# Stage B: that table as a stream -> keyed marker state -> sink.
# A micro-batch is bounded by the source option (maxFilesPerTrigger /
# maxOffsetsPerTrigger), which bounds the keys and therefore the partitions read.
# ---------------------------------------------------------------------------
def lookup_stage_sink(store_path: str, platforms: DataFrame, pages_dir: str, buckets: int):
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, _ = messages.parse(batch)
        routed, _ = messages.route(good, platforms)
        req = routed.withColumn("key_bucket", ps.key_bucket("pos_name", buckets)).persist()
        store = ps.read_for_keys(spark, store_path, req, "pos_name", buckets)
        s = store.select(F.col("table_name").alias("_t"), F.col("key_bucket").alias("_b"),
                         F.col("row_key").alias("_k"), F.col("url").alias("page_url"),
                         F.col("html").alias("page_html"))
        hits = (s.join(req, (F.col("_t") == F.col("key_name")) & (F.col("_b") == F.col("key_bucket"))
                       & (F.col("_k") == F.col("pos_name")))
                .where(~lookup.is_miss(lookup.MISS_NULL_OR_EMPTY)))
        snapshots(hits).write.mode("overwrite").parquet(f"{pages_dir}/batch={batch_id}")
        req.unpersist()
    return sink


def start_two_stage(spark: SparkSession, notices: DataFrame, store_path: str, platforms: DataFrame,
                    seed_markers: DataFrame, work_dir: str, out_dir: str, buckets: int = ps.DEFAULT_BUCKETS,
                    available_now: bool = False, task_kafka: dict | None = None, ttl_days: float = mk.TTL_DAYS):
    """Runs stage A then stage B; returns both queries (B last)."""
    pages_dir = f"{work_dir}/pages"
    a = (notices.writeStream.foreachBatch(lookup_stage_sink(store_path, platforms, pages_dir, buckets))
         .option("checkpointLocation", f"{work_dir}/ckpt_a"))
    qa = _trigger(a, available_now).start()
    if available_now:
        qa.awaitTermination()
    pages = spark.readStream.schema(mk.SNAPSHOT).parquet(pages_dir)
    new = new_items_stream(pages.drop("batch"), seed_markers, int(ttl_days * DAY_MS))
    b = new.writeStream.foreachBatch(write_batch(out_dir, task_kafka)).option("checkpointLocation", f"{work_dir}/ckpt_b")
    with mk.state_settings(spark):
        return qa, _trigger(b, available_now).start()
