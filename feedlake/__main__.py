"""Command-line entry: run one of the application's jobs.

    python -m feedlake list
    python -m feedlake run <query-or-job> --input DIR --output DIR [--master local[8]]
    python -m feedlake job <job> --table articles=DIR --table pages=DIR --output DIR
    python -m feedlake stream --notices DIR --pages DIR --markers DIR --output DIR
                              --checkpoint DIR [--buckets N] [--once]

``run`` executes any registered query / job (or one of the job aliases
below) over the tables in ``--input`` and writes its result as Parquet to
``--output``. ``job`` runs a job of ``plans.jobs`` on the tables it is given. ``stream`` starts the
flagship feed-increment stream over a folder of notice files (JSON lines
``{"msg_seq":..,"value":..}``); on a cluster the source is Kafka. ``--pages`` is
the page table (``table_name, row_key, url, html``), ``--markers`` the markers an
earlier crawl left (``page_url, last_key``; may be missing). With ``--buckets``
the page table is in the layout of ``sources.page_store`` and each micro-batch
reads only the partitions of its keys.
"""
from __future__ import annotations

import argparse
import os
import sys


# The application's batch entry points, by what they do.
JOBS = {
    "summary-backfill-40005": "job_backfill_200_write",
    "digest-backfill-40001": "job_backfill_300",
    "history-missing-summaries": "job_history_missing",
    "article-recrawl": "job_recrawl",
    "content-materialise": "job_content_table",
    "vip-home-pages-40002": "job_vip_home",
    "blog-pages-40002": "job_blog_pages",
    "portrait-update-40002": "prof_portrait_write",
    "vip-badge-check-40002": "str_seed_then_check",
    "vip-fill-40004": "job_vip_fill",
    "article-fill-40004": "job_article_fill",
    "known-user-recrawl-40004": "msg_fanout_two",
    "article-fill-40003": "job_author_fill",
    "missing-articles-40001": "job_missing_articles",
    "extra-vip-seeds-40001": "src_seed_list",
    "follower-expansion-40001": "grf_threshold_bfs",
    "follower-refresh": "job_follower_refresh",
    "post-fill-40005": "job_post_fill",
    "news-enrichment-40004": "snk_chained_write",
}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="feedlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--master", default=None)
    j = sub.add_parser("job")
    j.add_argument("name")
    j.add_argument("--table", action="append", default=[], help="NAME=PARQUET_DIR, see plans.jobs.Inputs")
    j.add_argument("--output", required=True)
    j.add_argument("--master", default=None)
    s = sub.add_parser("stream")
    s.add_argument("--notices", help="folder of notice files (JSON lines msg_seq, value)")
    s.add_argument("--bootstrap", help="Kafka bootstrap servers (notices and tasks)")
    s.add_argument("--topic", default="self_media", help="Kafka topic of page notices")
    s.add_argument("--task-topic", default="newsparser_news", help="Kafka topic for article tasks")
    s.add_argument("--max-per-trigger", type=int, default=None,
                   help="bound each micro-batch (maxOffsetsPerTrigger / maxFilesPerTrigger)")
    s.add_argument("--own-topic", default="newsparser_duration", help="Kafka topic for the tasks of platform 40001")
    s.add_argument("--pages", required=True)
    s.add_argument("--markers", default=None)
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True, help="folder that a restart finds again")
    s.add_argument("--buckets", type=int, default=None)
    s.add_argument("--once", action="store_true")
    s.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from feedlake.plans.catalog import QUERIES
    if a.cmd == "list":
        for alias, n in sorted(JOBS.items()):
            print(f"{alias:32s} -> {n}")
        for n in sorted(QUERIES):
            print(n)
        return 0
    from pyspark.sql import SparkSession

    from feedlake.session import ensure_checkpoint_dir
    b = SparkSession.builder.appName(f"feedlake-{a.cmd}").config("spark.ui.enabled", "false")
    if a.master:
        b = b.master(a.master)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.cmd == "run":
        QUERIES[JOBS.get(a.name, a.name)](spark, a.input).write.mode("overwrite").parquet(a.output)
        return 0
    if a.cmd == "job":
        from feedlake.plans import jobs
        given = dict(x.split("=", 1) for x in a.table)
        inputs = jobs.Inputs(spark, **{k: spark.read.parquet(v) for k, v in given.items()})
        jobs.JOBS[a.name](inputs).write.mode("overwrite").parquet(a.output)
        return 0
    from feedlake import schemas
    from feedlake.operators import sinks
    from feedlake.plans import flagship
    from feedlake.streaming import feed
    task_kafka = None
    if a.bootstrap:
        from feedlake.sources.tables import message_stream
        opts = {"kafka.bootstrap.servers": a.bootstrap, "subscribe": a.topic}
        if a.max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(a.max_per_trigger)
        notices = message_stream(spark, "kafka", **opts)          # value, msg_seq
        task_kafka = {"kafka.bootstrap.servers": a.bootstrap, "topic": a.task_topic, "own_topic": a.own_topic}
    else:
        r = spark.readStream.schema("msg_seq BIGINT, value STRING")
        if a.max_per_trigger:
            r = r.option("maxFilesPerTrigger", a.max_per_trigger)
        notices = r.json(a.notices)
    platforms = schemas.platforms(spark)
    markers = (sinks.read_if_exists(spark, a.markers, flagship.MARKER_SCHEMA) if a.markers
               else spark.createDataFrame([], flagship.MARKER_SCHEMA))
    bad = feed.start_rejects(notices, platforms, a.output, f"{a.checkpoint}/rejects", a.once)
    if a.buckets:
        _, q = feed.start_two_stage(spark, notices, a.pages, platforms, markers, a.checkpoint, a.output, a.buckets,
                                    a.once, task_kafka)
    else:
        q = feed.start(spark, notices, spark.read.parquet(a.pages), platforms, markers, a.output,
                       f"{a.checkpoint}/main", a.once, task_kafka)
    q.awaitTermination()
    bad.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
