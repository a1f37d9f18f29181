"""Batch jobs (JOB1-JOB14): thin compositions of operators. No job collects
rows to the driver; every per-row loop of the reference is a join."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import extract, lookup, messages, relational as rel, sinks, text as tx
from ..operators.article_pages import author_links, blog_articles, blog_links, blog_table, card_bodies, paid_articles
from ..operators.feeds import status_items, status_rows
from ..operators.keyed_tables import BucketTable
from ..operators.platform_pages import PROFILE_SPECS, page_items, profile_40002
from ..operators.profiles import vip_info
from ..session import scratch_path

K = schemas.TOPK_ARTICLES


@dataclass
class Inputs:
    """The tables the jobs work on; a job reads only those it names.

    articles   platform_id, user_id, title, url, ts, summary
    pages      table_name, row_key, url, html (one version per key)
    users      user_id, name, followers_count, vip, ..: one row per user
    user_rows  the same without a key: several rows per user
    authors    user_id of users that have articles
    responses  user_id, body: landed follower-count answers

    page_buckets: the number of buckets where ``pages`` is a bucketed table
    (``sources.page_store.write_bucketed``); its html is then not shuffled.
    """
    spark: SparkSession
    articles: DataFrame | None = None
    pages: DataFrame | None = None
    users: DataFrame | None = None
    user_rows: DataFrame | None = None
    authors: DataFrame | None = None
    responses: DataFrame | None = None
    page_buckets: int | None = None


def _order():
    return [F.col("ts").desc(), F.col("url")]


def body_text(html) -> F.Column:
    """Body = text of every paragraph, joined by ' '."""
    return F.array_join(F.transform(extract.paragraphs(html), lambda p: extract.text_of(p)), " ")


def article_text(html) -> F.Column:
    """Text of the article block ('' when the page is truncated)."""
    return extract.text_of(F.regexp_extract(html, "<article>(.*?)</article>", 1))


def backfill_200(t: Inputs) -> DataFrame:
    """JOB1 (40005): newest 3000, summary NULL -> detail page -> its body (ART5) cut to
    200 -> keyed update rows; a missing or broken page gives a recrawl task."""
    a = t.articles.where(F.col("platform_id") == 40005)
    todo = rel.topk_then_filter(a, _order(), K, F.col("summary").isNull()).select("platform_id", "url")
    lk = lookup.extracted(todo, t.pages, lambda p: card_bodies(p).select("table_name", "page_url", "body"), t.page_buckets)
    task = messages.crawl_task("platform_id", "url", schemas.RESULT_RECRAWL)
    return lk.select("url", F.substring("body", 1, schemas.SUMMARY_CUT_40005).alias("summary"),
                     F.when(F.col("body").isNull(), task).alias("task"))


def write_summaries(t: Inputs, table: BucketTable, version: int, tasks: str) -> None:
    """JOB1 with its writes: summaries are set by url in ``table`` (url, summary), of
    which only the touched buckets are rewritten, the tasks go to the folder ``tasks``.
    The rows are written first and both read from there; a replay writes the same."""
    path = f"{tasks}/rows/version={version}"
    rows = backfill_200(t)
    rows.write.mode("overwrite").parquet(path)
    rows = t.spark.read.schema(rows.schema).parquet(path)
    table.update(rows.where("task is null").groupBy("url").agg(F.min("summary").alias("summary")), ["summary"], version)
    rows.where("task is not null").select(F.col("task").alias("value")).write.mode("overwrite").text(f"{tasks}/tasks/version={version}")


def backfill_300(t: Inputs) -> DataFrame:
    """JOB2 (40001): newest 3000, summary NULL -> page -> article text ->
    digest; digest and summary (cut 300) set together; misses ignored."""
    a = t.articles.where(F.col("platform_id") == 40001)
    todo = rel.topk_then_filter(a, _order(), K, F.col("summary").isNull()).select("platform_id", "url")

    def digests(pages):
        return pages.where("html <> ''").select("table_name", "page_url", tx.digest(article_text("html")).alias("digest"))

    dg = lookup.extracted(todo, t.pages, digests, t.page_buckets).where("hit")
    return dg.select("url", "digest", fn.intercept("digest", schemas.SUMMARY_CUT).alias("summary"))


def history_missing(t: Inputs) -> DataFrame:
    """JOB3: urls without summary and their stored content (listed only)."""
    a = t.articles.where(F.col("summary").isNull()).select("platform_id", "url")
    return lookup.extracted(a, t.pages, _measured, t.page_buckets).select("url", "content_len", "content_md5")


def _measured(pages: DataFrame) -> DataFrame:
    return pages.select("table_name", "page_url", F.length("html").alias("content_len"), F.md5("html").alias("content_md5"))


def recrawl(t: Inputs) -> DataFrame:
    """JOB4: newest 3000 articles -> crawl task 0 each."""
    top = rel.topk(t.articles, _order(), K)
    return top.select("url", messages.crawl_task("platform_id", "url", schemas.RESULT_CRAWL).alias("task"))


def materialise(t: Inputs) -> DataFrame:
    """JOB5: the four platforms' urls with a non-empty summary -> stored page ->
    what is kept of its content; ``write_contents`` is the write.

    One scan with ``platform_id IN (...)`` instead of four per-platform
    views (on the partitioned table each view prunes to its partition; on a
    derived platform column four views would scan four times)."""
    hits = _stored_contents(t)
    return hits.select(F.col("page_url").alias("url"), F.length("html").alias("content_len"), F.md5("html").alias("content_md5"),
                       extract.title("html").alias("title"))


def _stored_contents(t: Inputs) -> DataFrame:
    """``table_name, page_url, html`` of JOB5's urls. The store holds one version a key,
    so each is found once, however many catalogue rows name it."""
    urls = t.articles.where(F.col("platform_id").isin(40001, 40002, 40003, 40004) & (F.col("summary") != ""))
    return lookup.found_pages(urls, t.pages, t.page_buckets).where(F.col("html").isNotNull())


def write_contents(t: Inputs, table: BucketTable, version: int) -> None:
    """JOB5 with its write: ``table`` (url, content, run) gets the found pages by url; of
    two runs the later one's content stays. Only the buckets of the found urls are
    rewritten; a replayed version gives the same table."""
    found = _stored_contents(t).select(F.col("page_url").alias("url"), F.col("html").alias("content"))
    table.put(found.withColumn("run", F.lit(version)), "run", version)


def _lookup_pages(t: Inputs, users: DataFrame, prefix: str) -> tuple[DataFrame, Column]:
    """Users -> the page at ``prefix`` + user id (``page_url, url, html``) and the miss rule."""
    asked = users.select("user_id", messages.build_url(prefix, "user_id").alias("page_url"))
    found = lookup.lookup_by_url(asked, t.pages, "page_url", ("url", "html"), prefix="")
    return found, lookup.is_miss(lookup.MISS_NULL_OR_EMPTY, url="url", html="html")


def _task(platform: int, result: int) -> Column:
    return messages.crawl_task(F.lit(platform), "page_url", result).alias("task")


def portraits(t: Inputs) -> DataFrame:
    """PROF3 (40002): users -> home page -> the first image of the picture block;
    ``user_id, portrait`` of the pages that have one."""
    lk, _ = _lookup_pages(t, t.users.select("user_id").distinct(), schemas.URLS[40002]["home_page"])
    items = page_items(lk.where(F.col("html").isNotNull()), 40002, "user_id", "html", PROFILE_SPECS)
    portrait = F.try_element_at("fields", F.lit("portrait"))
    return items.where(portrait.isNotNull()).select(F.col("id").alias("user_id"), portrait.alias("portrait"))


def write_portraits(t: Inputs, table: BucketTable, version: int) -> None:
    """PROF3 with its write (SNK6): only the buckets of the found users are rewritten."""
    path = scratch_path(t.spark, "portraits")
    portraits(t).write.parquet(path)   # read for its buckets and for the update
    table.update(t.spark.read.parquet(path), ["portrait"], version)


def vip_home(t: Inputs) -> DataFrame:
    """JOB6: VIP candidates -> home page -> profile (PROF1) or crawl task."""
    cand = rel.one_row_per_key(
        t.user_rows.where((F.col("followers_count") > schemas.FOLLOWER_GATE_VIP) | F.col("vip")),
        "user_id", [F.col("followers_count"), F.col("vip"), -F.col("row_id")]).select("user_id")
    lk, miss = _lookup_pages(t, cand, schemas.URLS[40002]["home_page"])
    hits = page_items(lk.where(~miss), 40002, "user_id", "html", PROFILE_SPECS, keep=("page_url",))
    tasks = lk.where(miss).select(F.col("user_id").cast("string").alias("user_id"), _task(40002, schemas.RESULT_CRAWL))
    return profile_40002(hits, F.col("page_url")).drop("id").unionByName(tasks, allowMissingColumns=True)


def blog_pages(t: Inputs, month: str = "2016-05") -> DataFrame:
    """JOB7: VIP users -> first list page -> number of list pages -> list pages 2..N
    -> their links of the month (FEED11) -> article pages -> article rows (ART6). A
    page that is missing at any step gives its crawl task; a first list page that was
    read is acknowledged."""
    first, miss = _lookup_pages(t, t.users.where("vip"), schemas.URLS[40002]["article_list"])
    n = extract.list_page_count(F.col("html"))
    lists = first.where(~miss).select("user_id", "page_url", n.alias("n"))
    acks = first.select("page_url", messages.crawl_task(
        F.lit(40002), "page_url", F.when(miss, schemas.RESULT_CRAWL).otherwise(schemas.RESULT_PARSED)).alias("task"))
    asked = messages.page_range(lists, F.lit(2), F.col("n")).select(
        "user_id", F.concat("page_url", F.lit("?page="), F.col("page_no").cast("string")).alias("page_url"))
    more = lookup.lookup_by_url(asked, t.pages, "page_url", ("url", "html"), prefix="")
    links = blog_links(more.where(~miss).withColumnRenamed("user_id", "id"), month).select(F.col("url").alias("page_url")).distinct()
    arts = lookup.lookup_by_url(links, t.pages, "page_url", ("url", "html"), prefix="")
    rows = blog_articles(arts.where(~miss).withColumn("id", F.lit(0)), month)
    tasks = (acks.unionByName(more.where(miss).select("page_url", _task(40002, schemas.RESULT_CRAWL)))
             .unionByName(arts.where(miss).select("page_url", _task(40002, schemas.RESULT_CRAWL))))
    return rows.unionByName(tasks, allowMissingColumns=True)


def vip_fill(t: Inputs) -> DataFrame:
    """JOB8: NOT IN candidates -> info document -> profile (PROF8); a missing document
    or one that is no JSON gives a crawl task."""
    rows = t.user_rows.where(
        (F.col("recommend") > 6) | (F.col("marrow") > 0) | (F.col("vip_level") > 0))
    v = t.users.where("vip").select("user_id")
    cand = rel.not_in(t.spark, rows, v, "user_id").select("user_id").distinct()
    lk, miss = _lookup_pages(t, cand, schemas.URLS[40004]["user_info"])
    bad = miss | F.try_parse_json("html").isNull()
    tasks = lk.where(bad).select(F.col("user_id").cast("string").alias("user_id"), _task(40004, schemas.RESULT_CRAWL))
    return vip_info(lk.where(~bad), "html").unionByName(tasks, allowMissingColumns=True)


def article_fill(t: Inputs) -> DataFrame:
    """JOB9: distinct VIP users -> blog page -> its rows (FEED8) or recrawl task."""
    v = t.user_rows.where("vip").select("user_id").distinct()
    lk, miss = _lookup_pages(t, v, schemas.URLS[40004]["blog"])
    tasks = lk.where(miss).select("page_url", _task(40004, schemas.RESULT_RECRAWL))
    return blog_table(lk.where(~miss)).unionByName(tasks, allowMissingColumns=True)


def missing_articles(t: Inputs) -> DataFrame:
    """JOB10: users without articles -> home page -> every status (FEED7) or recrawl task."""
    u = rel.without_rows_in(t.users.select("user_id"), t.authors, "user_id")
    lk, miss = _lookup_pages(t, u, schemas.URLS[40001]["home_page"])
    docs = lk.where(~miss).select("page_url", extract.status_text(F.col("html")).alias("doc"))
    items = status_rows(status_items(docs, ["page_url"]))
    return items.unionByName(lk.where(miss).select("page_url", _task(40001, schemas.RESULT_RECRAWL)), allowMissingColumns=True)


def author_fill(t: Inputs) -> DataFrame:
    """JOB11: all 40003 users -> author page -> its links (FEED10) -> article pages ->
    article rows (ART7). An author page that is not stored is taken again (task 2); a
    broken one (no list, or a row without a link: what stands before it counts) and
    missing or broken article pages give crawl tasks (0)."""
    asked = t.users.select("user_id", messages.build_url(schemas.URLS[40003]["author"], "user_id").alias("page_url"))
    lk = lookup.lookup_by_url(asked.select("page_url").distinct(), t.pages, "page_url", ("html",), prefix="")
    lost = F.col("html").isNull()
    read = author_links(lk.where(~lost))
    links = read.select(F.explode("links").alias("page_url")).distinct()
    arts = lookup.lookup_by_url(links, t.pages, "page_url", ("html",), prefix="")
    rows = paid_articles(arts.where(~lost).withColumn("id", F.lit(0)))
    tasks = (lk.where(lost).select("page_url", _task(40003, schemas.RESULT_RECRAWL))
             .unionByName(read.where("broken").select("page_url", _task(40003, schemas.RESULT_CRAWL)))
             .unionByName(arts.where(lost).select("page_url", _task(40003, schemas.RESULT_CRAWL))))
    return rows.unionByName(tasks, allowMissingColumns=True)


def follower_refresh(t: Inputs) -> DataFrame:
    """JOB13: landed fans-count responses -> keyed update of followers. The
    response source is a parameter (Q9). Unparsable responses leave the row
    unchanged."""
    u = t.users.select("user_id", "followers_count")
    upd = t.responses.select("user_id", F.get_json_object("body", "$.count").try_cast("bigint").alias("followers_count"))
    upd = upd.where(F.col("followers_count").isNotNull())
    return sinks.keyed_update(u, upd, ["user_id"], ["followers_count"])


#: Jobs by name, for the command line.
JOBS = {f.__name__: f for f in (backfill_200, backfill_300, history_missing, recrawl, materialise, vip_home, blog_pages,
                                portraits, vip_fill, article_fill, missing_articles, author_fill, follower_refresh)}
