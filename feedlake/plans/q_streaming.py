"""Proof queries that run real Structured Streaming queries (file source,
``availableNow``) over data derived from the driver tables, then read the
sink back (SRC1, STR1-STR5)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import lookup, messages
from ..session import scratch_path
from ..sources import page_store, standins
from ..sources.tables import table
from ..sources.dictionaries_text import keyword_dictionary
from ..streaming import enrichment, feed
from . import enrich, flagship
from .oracle_common import PARSED_SQL
from .q_flagship import FLAGSHIP_SQL
from .q_messages import W_ROUTED
from .q_text import DIGEST_SQL, NEWS_SQL, STOCK_SQL, _with_unscorable
from .registry import query

NOTICE_SCHEMA = T.StructType([T.StructField("msg_seq", T.LongType()), T.StructField("value", T.StringType())])


def _land_notices(spark, d, store=None) -> str:
    """Land the notices as JSON-lines files (what a topic dump looks like)."""
    path = scratch_path(spark, "notices")
    standins.messages(spark, d, store).write.mode("overwrite").json(path)
    return path


def _notice_stream(spark, path):
    return spark.readStream.schema(NOTICE_SCHEMA).json(path)


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("str_stream_flagship", FLAGSHIP_SQL)
def q_str_stream_flagship(spark, d):
    """STR1/STR2/INC1: the flagship as a stream; markers seeded from the
    stored marker table, then kept as keyed state."""
    store = standins.feed_store(spark, d)
    src = _land_notices(spark, d, store)
    out = scratch_path(spark, "flagship_out")
    q = feed.start(spark, _notice_stream(spark, src), store, schemas.platforms(spark),
                   flagship.page_markers(spark, d, ("platform_id",)), out, scratch_path(spark, "flagship_ckpt"),
                   available_now=True)
    _run(q)
    return spark.read.parquet(f"{out}/articles").drop("batch")


@query("str_two_stage_flagship", FLAGSHIP_SQL)
def q_str_two_stage_flagship(spark, d):
    """STR1/STR2 in the pruned form: the page table lies in key buckets, and a micro-batch
    opens only the partitions of its own notices' keys."""
    feed_pages, buckets = standins.feed_store(spark, d), 16
    path = scratch_path(spark, "page_store")
    page_store.write_store(feed_pages.select("table_name", "row_key", "url", "html"), path, buckets)
    src, out = _land_notices(spark, d, feed_pages), scratch_path(spark, "two_stage_out")
    _, q = feed.start_two_stage(spark, _notice_stream(spark, src), path, schemas.platforms(spark),
                                flagship.page_markers(spark, d, ("platform_id",)), scratch_path(spark, "two_stage_work"), out, buckets,
                                available_now=True)
    _run(q)
    return spark.read.parquet(f"{out}/articles").drop("batch")


@query("src_message_stream", standins.with_ctes("page_store", "messages") + f""", parsed AS ({PARSED_SQL})
SELECT msg_seq, attr_id, key_name, pos_name, reason FROM parsed""")
def q_src_message_stream(spark, d):
    """SRC1 + MSG1/MSG2 on a stream: every notice parsed once, bad ones
    kept with a reason."""
    src = _land_notices(spark, d)
    out, ck = scratch_path(spark, "parsed"), scratch_path(spark, "parsed_ckpt")
    c = messages.classify(_notice_stream(spark, src))
    q = (c.select("msg_seq", "attr_id", "key_name", "pos_name", "reason").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out)


@query("str_enrich", W_ROUTED + """
SELECT msg_seq, page_url, CAST(length(page_html) AS INTEGER) AS html_len FROM looked""")
def q_str_enrich(spark, d):
    """STR2: stream-static left join of notices with the page table."""
    src = _land_notices(spark, d)
    out, ck = scratch_path(spark, "enrich"), scratch_path(spark, "enrich_ckpt")
    good, _ = messages.parse(_notice_stream(spark, src))
    routed, _ = messages.route(good, schemas.platforms(spark))
    lk = lookup.lookup(routed, standins.page_store(spark, d))
    q = (lk.select("msg_seq", "page_url", F.length("page_html").alias("html_len")).writeStream
         .format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out)


UNSCORABLE_SQL = """documents AS (SELECT doc_id, text FROM documents UNION ALL
  SELECT -1 - doc_id, regexp_replace(text, '[\\p{L}\\p{N}]', '-', 'g') FROM documents WHERE doc_id % 10 = 0)"""


@query("str_enrich_news", "WITH " + UNSCORABLE_SQL + f""",
news AS ({NEWS_SQL}),
info AS (SELECT '{schemas.URLS[40004]['blog']}' || CAST(doc_id AS VARCHAR) AS url, stock AS stock_pairs FROM ({STOCK_SQL}) x),
dgs AS (WITH {DIGEST_SQL} SELECT * FROM digests)
SELECT n.url, n.title, n.news_time, n.industry, n.section, n.stock, n.digest, n.summary, n.sentiment, i.stock_pairs,
       CAST(NULL AS VARCHAR) AS reason FROM news n JOIN info i USING (url)
UNION ALL
SELECT '{schemas.URLS[40004]['blog']}' || CAST(doc_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no_digest'
FROM dgs WHERE temp_digest IS NULL""")
def q_str_enrich_news(spark, d):
    """NLP1-NLP9 + SNK11 behind the 40004 stream: posts over several micro-batches,
    with a saved model and dictionary; article -> digest -> news, each from what was
    written of the one before. Every tenth post comes once more without words (its
    digest fails), and some posts come twice (written once)."""
    docs = _with_unscorable(spark, d)
    all_docs = table(spark, d, "documents")
    models, out = scratch_path(spark, "models"), scratch_path(spark, "news_out")
    model, classes = enrich.sentiment_model(all_docs, table(spark, d, "labels"))
    enrichment.save_models(models, 1, model, classes, keyword_dictionary(spark, d))
    land = scratch_path(spark, "posts")
    posts = enrich.as_posts(docs)
    for part in (0, 1):
        again = (F.pmod(F.col("doc_id"), F.lit(2)) == part) | (F.pmod(F.col("doc_id"), F.lit(7)) == 0)
        posts.where(again).write.mode("append").parquet(land)
        _run(enrichment.start(spark.readStream.schema(enrichment.POST).parquet(land), models, out, f"{out}/ckpt", True))
    read = lambda name: spark.read.parquet(f"{out}/{name}").drop("batch")
    news = (read("news_info").join(read("article_info").select("url", F.col("stock").alias("stock_pairs")), "url")
            .select("url", "title", "news_time", "industry", "section", "stock", "digest", "summary", "sentiment", "stock_pairs",
                    F.lit(None).cast("string").alias("reason")))
    bad = read("rejects").select(enrich.article_url().alias("url"), "reason")
    return news.unionByName(bad, allowMissingColumns=True)


@query("str_dedupe", """SELECT DISTINCT user_id, event_type, props FROM events""")
def q_str_dedupe(spark, d):
    """STR5: replay-safe de-duplication on the event stream over several
    micro-batches: the events land in three files, the first of them again at the
    end, and repeats lie in different batches. The watermark's delay covers the
    whole stream, so the kept keys are the distinct ones (only the key columns are
    returned: which duplicate survives is not specified)."""
    ev = table(spark, d, "events")
    land = scratch_path(spark, "events")
    out, ck = scratch_path(spark, "dedupe"), scratch_path(spark, "dedupe_ckpt")
    for part in (0, 1, 2, 0):   # what each landing adds is a micro-batch of its own, in as many files as Spark writes
        ev.where(F.col("event_id") % 3 == part).write.mode("append").parquet(land)
        st = spark.readStream.schema(ev.schema).parquet(land).withColumn("ets", F.col("ts").cast("timestamp"))
        dd = (st.withWatermark("ets", "3650 days").dropDuplicatesWithinWatermark(["user_id", "event_type", "props"])
              .select("user_id", "event_type", "props"))
        _run(dd.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    return spark.read.parquet(out)


@query("str_seed_then_check", standins.with_ctes("users", "page_store", "profile_index") + """,
seeds AS (SELECT user_id FROM users WHERE followers_count < 500),
replies AS (SELECT s.user_id, p.html FROM seeds s JOIN profile_index i USING (user_id)
            JOIN page_store p ON p.page_id = i.page_id)
SELECT user_id, strpos(html, '<b>') > 0 AS badge, 1 AS result FROM replies""")
def q_str_seed_then_check(spark, d):
    """STR4 / PROF2: seed tasks from a batch query (small users), then a
    stream of landed replies is checked for the badge; every reply is
    acknowledged (result 1)."""
    seeds = standins.users(spark, d).where(F.col("followers_count") < schemas.FOLLOWER_GATE_VIP).select("user_id")
    seed_path = scratch_path(spark, "seed_tasks")
    (seeds.select(messages.crawl_task(F.lit(40002), messages.build_url(schemas.URLS[40002]["home_page"], "user_id"),
                                      schemas.RESULT_CRAWL).alias("value")).write.mode("overwrite").text(seed_path))
    replies = standins.profile_lookup(spark, d, seeds).where(F.col("page_html").isNotNull())
    land = scratch_path(spark, "replies")
    replies.select("user_id", "page_html").write.mode("overwrite").parquet(land)
    st = spark.readStream.schema("user_id BIGINT, page_html STRING").parquet(land)
    out, ck = scratch_path(spark, "badge"), scratch_path(spark, "badge_ckpt")
    chk = st.select("user_id", (F.regexp_count("page_html", F.lit("<b>")) > 0).alias("badge"),
                    F.lit(schemas.RESULT_PARSED).alias("result"))
    q = (chk.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out)
