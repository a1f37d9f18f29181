"""Lookups in a page store that is a bucketed table, extractors behind the jobs, seeds."""
import re

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import article_pages as ap
from feedlake.operators import lookup, seeds
from feedlake.operators import platform_pages as pp
from feedlake.operators.keyed_tables import BucketTable
from feedlake.plans import flagship, jobs
from feedlake.sources import page_store, standins

from .conftest import SF0001


def above_html_scan(df) -> list[str]:
    """Operators between the stored table's scan of html and the join that reads it."""
    text = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda ln: re.match(r"[ :+\-]*", ln).end()
    out = []
    for i, ln in enumerate(text):
        if "FileScan parquet spark_catalog." in ln and re.search(r"\bhtml#", ln):
            d = depth(ln)
            for up in reversed(text[:i]):
                if depth(up) < d:
                    d = depth(up)
                    out.append(up.strip(" :+-").split(" ")[0].split("(")[0])
                    if "Join" in up:
                        break
    return out


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("buckets", [4, 16])   # fewer and more than the shuffle partitions
def test_bucketed_store_is_not_shuffled(spark, tmp_path, no_broadcast, buckets):
    pages = standins.page_store(spark, SF0001)
    store = page_store.write_bucketed(pages.select("table_name", "row_key", "url", "html"), page_store.fresh_name("t"),
                                      buckets, str(tmp_path / "store"))
    articles = standins.articles(spark, SF0001)
    here = jobs.Inputs(spark, articles=articles, pages=pages)
    there = jobs.Inputs(spark, articles=articles, pages=store, page_buckets=buckets)
    for job in (jobs.materialise, jobs.history_missing, jobs.backfill_200, jobs.backfill_300):
        got = job(there)
        ops = above_html_scan(got)
        assert "ShuffledHashJoin" in ops and not {"Exchange", "Sort", "ShuffleQueryStage"} & set(ops), (job.__name__, ops)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, job(here).collect()), key=str)


def test_flagship_on_bucketed_store(spark, tmp_path, no_broadcast):
    feed = standins.feed_store(spark, SF0001)
    notices = standins.messages(spark, SF0001, feed)
    store = page_store.write_bucketed(feed.select("table_name", "row_key", "url", "html"), page_store.fresh_name("t"), 8,
                                      str(tmp_path / "store"))
    here, rejects, misses = flagship.notices_to_pages(notices, feed, schemas.platforms(spark))
    there, _, lost = flagship.notices_to_pages(notices, store, schemas.platforms(spark), buckets=8)
    ops = above_html_scan(there)
    assert "ShuffledHashJoin" in ops and not {"Exchange", "Sort"} & set(ops), ops
    assert sorted(map(str, there.collect())) == sorted(map(str, here.collect()))
    assert sorted(map(tuple, lost.collect())) == sorted(map(tuple, misses.collect()))


def test_extracted_reads_a_page_once_for_many_requests(spark):
    store = spark.createDataFrame([("40001", "a", "a", "<p>x</p>"), ("40002", "a", "a", "other"), ("40001", "n", "n", None)],
                                  "table_name string, row_key string, url string, html string")
    asked = spark.createDataFrame([(i, 40001, u) for i, u in enumerate(["a", "a", "a", "b", "n", None])], "i long, platform_id int, url string")
    got = lookup.extracted(asked, store, lambda p: p.select("table_name", "page_url", F.length("html").alias("n")))
    assert got.columns == ["i", "platform_id", "url", "n", "hit"]
    assert [(r.i, r.n, r.hit) for r in got.orderBy("i").collect()] == [
        (0, 8, True), (1, 8, True), (2, 8, True), (3, None, False), (4, None, True), (5, None, False)]
    assert lookup.extracted(asked.limit(0), store, lambda p: p.select("table_name", "page_url")).count() == 0


def _detail(doc, title="T- 微博", before="<script>var a = 1;</script>"):
    return f"<html><head><title>{title}</title></head>{before}<script>FM.view({doc})</script></html>"


CARD = ('<div tbinfo=\\"x\\"><div node-type=\\"feed_list_content\\"> one &amp;\\n two </div><p node-type=\\"feed_list_reason\\">why</p>'
        '<p node-type=\\"feed_list_reason\\">and how</p></div><div tbinfo=\\"y\\"><b node-type=\\"feed_list_content\\">no</b></div>')
NS = '"ns":"pl.content.weiboDetail.index"'


@pytest.mark.parametrize("html, body", [
    (_detail(f'{{{NS},"html":"{CARD}"}}'), "one & two why and how"),
    (_detail(f'{{{NS},"html":"<div tbinfo=1></div>"}}'), " "),                  # a card that says nothing
    (_detail(f'{{{NS},"html":"<div>no card</div>"}}'), None),
    (_detail(f'{{{NS}}}'), None),                                               # no html in the document
    (_detail(f'{{{NS},"html":'), ""),                                           # broken JSON
    (_detail(f'[1, "{NS[1:-1]}]'), ""),                                         # no object
    (_detail('{"ns":"other"}', before=""), None),                               # the first script counts; no html
    ("<html><script>x</script></html>", None), ("<html>no script</html>", None), ("", None), (None, None),
])
def test_detail_page_body(spark, html, body):
    df = spark.createDataFrame([("u", html, 7)], "page_url string, html string, extra int")
    r = ap.card_bodies(df).first()
    assert r.asDict().keys() == {"page_url", "extra", "title", "body"} and r.body == body
    assert r.title == ("T" if html and "T- " in html else None if html is None else "")


def test_author_links(spark):
    def page(rows, of="list1"):
        return f'<html><table id="{of}">{rows}</table><table id="other"><tr><td><a href="no">n</a></td></tr></table></html>'

    row = '<tr><td><a href="a{0}">t</a></td><td><a href="x">u</a></td></tr>'.format
    pages = [("all", page(row(1) + row(2))), ("torn", page(row(1) + "<tr><td>-</td></tr>" + row(2))), ("none", page("")),
             ("unlisted", page(row(1), "list2")), ("empty", ""), ("null", None)]
    got = ap.author_links(spark.createDataFrame(pages, "page_url string, html string")).collect()
    at = "http://moer.jiemian.com/"
    assert {r.page_url: (r.links, r.broken) for r in got} == {
        "all": ([at + "a1", at + "a2"], False), "torn": ([at + "a1"], True), "none": ([], False),
        "unlisted": ([], True), "empty": ([], True), "null": ([], True)}


def test_panels_in_one_walk():
    html = ('<a class="user" href="out">o</a><div id="gowell"><p><a class="user" href="g1">u</a><a href="pic">p</a></p><a class="user">no link</a></div>'
            '<ul class="Mt10 BlogMUl BlockStyle1 Ml30 Fl"><li><a href="b1">u</a><a href="more">m</a></li><li>nobody</li></ul>'
            '<div id="goStock"><ul><li><a href="stock">s</a><a href="s1">u</a></li><li><a href="s2">u</a></li></ul></div>'
            '<ul class="BlogMUl BlockStyle1 Ml30 Fl Mt10"><li><a href="b2">u</a></li></ul>')
    got = [(n, i, x.get("link")) for n, i, x in pp.area_items(seeds.PORTAL_40002, html)]
    assert got == [(0, 0, "g1"), (0, 1, None), (1, 0, "b1"), (1, 1, None), (2, 0, "s1"), (2, 1, "s2")]
    top = ('<ul><li><a href="blog/0">x</a></li></ul><div id="topics"><ul><li><a href="blog/7">u</a><ul><li><a href="blog/8">n</a></li></ul></li>'
           '<li><a href="blog/9">u</a></li></ul><ul><li><a href="blog/1">second list</a></li></ul></div>')
    assert [x["link"] for _, _, x in pp.area_items(seeds.TOP_40004, top)] == ["blog/7", "blog/9"]
    assert pp.area_items(seeds.PORTAL_40002, None) == [] and pp.area_items(seeds.TOP_40004, "<div id=topics>") == []


def test_summaries_are_written_by_bucket_and_replayed(spark, tmp_path):
    pages = spark.createDataFrame([("40005", f"u{i}", f"u{i}", _detail(f'{{{NS},"html":"{CARD}"}}') if i % 2 else "") for i in range(8)],
                                  "table_name string, row_key string, url string, html string")
    articles = spark.createDataFrame([(40005, f"u{i}", i, "has" if i == 1 else None) for i in range(10)] + [(40001, "u3", 99, None)],
                                     "platform_id int, url string, ts long, summary string")
    t = BucketTable(spark, str(tmp_path / "t"), ["url"], "url string, summary string", 8)
    t.create(articles.where("platform_id = 40005").select("url", "summary"))
    for version in (1, 1):
        jobs.write_summaries(jobs.Inputs(spark, articles=articles, pages=pages), t, version, str(tmp_path / "out"))
    said = "one & two why and how"
    assert {r.url: r.summary for r in t.current().collect()} == {
        f"u{i}": "has" if i == 1 else said if i in (3, 5, 7) else None for i in range(10)}
    tasks = [r.value for r in spark.read.text(str(tmp_path / "out/tasks/version=1")).collect()]
    assert sorted(re.search(r'"url":"(\w+)"', x)[1] for x in tasks) == ["u0", "u2", "u4", "u6", "u8", "u9"]
    assert all('"result":"2"' in x for x in tasks)


def _post(images, frame="p_wenz"):
    return (f'<html><head><title>Head_淘股吧</title></head><img src="http://i/out"><div class="p_coten"> a </div><div class="{frame}">'
            f'<div class="p_coten">b &amp;\n c<br>d</div>{images}</div><div class="{frame}"><img src="http://i/second"></div></html>')


@pytest.mark.parametrize("html, want", [
    (_post('<img src="http://i/1"><img src="/b.gif" data-original="http://l/2"/><img src="http://css.taoguba.com.cn/x">'),
     ("Head", "a b & cd", ["http://i/1", "http://l/2"])),
    (_post('<img><img data-original="http://css.taoguba.com.cn/y">'), ("Head", "a b & cd", [""])),
    (_post(""), ("Head", "a b & cd", [])),
    (_post("", "other"), ("Head", None, None)), ("", ("", None, None)), (None, (None, None, None)),
])
def test_post_of_40004(spark, html, want):
    df = spark.createDataFrame([("u", html)], "page_url string, html string")
    assert tuple(ap.posts_40004(df).first())[1:] == want


def _home(head=None, counts=None):
    head = head if head is not None else ('<b class=\\"username\\"> Ann </b><img src=\\"f.png\\"><img src=\\"no\\"><p class=\\"pf_intro\\">x\\n y</p>'
                                          'key=profile_head&value=vuser_guest')
    counts = counts if counts is not None else "<td><strong>1</strong></td><td><i>of</i><strong>42</strong><strong>7</strong></td>"
    return (f'<script>FM.view({{"ns":"pl.other","html":""}})</script>\n<script>FM.view({{"ns":"pl.header.head.index","html":"{head}"}})</script>'
            f'\n<script>FM.view({{"ns":"","domid":"Pl_Core_T8CustomTriColumn__3","html":"{counts}"}})</script>')


@pytest.mark.parametrize("html, want", [
    (_home(), ("9", "Ann", "f.png", "x y", 42, True)),
    (_home(head='<b class=\\"username\\">B</b><img><p class=\\"pf_intro\\"></p>'), ("9", "B", "", "", 42, False)),
    (_home(head='<img src=\\"f\\"><p class=\\"pf_intro\\"></p>'), None),              # no name
    (_home(counts="<td><strong>1</strong></td>"), None), (_home(counts="<td></td><td><strong>x</strong></td>"), None),
    (_home().replace('"html":"<td>', '"html:<td>'), None), (_home().split("\n<script>FM.view({\"ns\":\"\"")[0], None), ("", None), (None, None),
])
def test_home_page_of_40005(spark, html, want):
    r = pp.profiles_40005(spark.createDataFrame([("http://weibo.com/9", html)], "page_url string, html string")).first()
    if want is None:
        assert tuple(r)[1:-1] == (None,) * 6 and '"result":"2"' in r.task and '"attrid":"40005"' in r.task
    else:
        assert (r.user_id, r.name, r.portrait, r.introduction, r.followers_count, r.vip) == want and r.task is None


def test_portraits_update_only_what_was_found(spark, tmp_path):
    pages = spark.createDataFrame([("40002", f"http://blog.cnfol.com/{i}", "x", h) for i, h in enumerate(
        ['<html><div class="BloggerPic"><img src="a.png"><img src="b.png"></div></html>', '<html><img src="c.png"></html>', "", None])],
        "table_name string, row_key string, url string, html string")
    users = spark.createDataFrame([(i,) for i in range(5)], "user_id long")
    t = BucketTable(spark, str(tmp_path / "t"), ["user_id"], "user_id bigint, portrait string", 4)
    t.create(users.select("user_id", F.lit("old").alias("portrait")))
    jobs.write_portraits(jobs.Inputs(spark, users=users, pages=pages), t, 1)
    assert {r.user_id: r.portrait for r in t.current().collect()} == {0: "a.png", 1: "old", 2: "old", 3: "old", 4: "old"}


def test_texts_of_few_splits_are_spread(spark, tmp_path):
    from feedlake.operators import text as tx
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    many = spark.range(50).repartition(spark.sparkContext.defaultParallelism)
    assert tx.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in tx.spread(one).collect()) == list(range(50)) and tx.spread(many) is many


def test_one_row_group_in_many_splits_is_spread(spark, tmp_path):
    """Its rows are read by one task, whatever the number of splits."""
    import shutil
    from feedlake.plans.catalog import QUERIES
    d, cores, key = tmp_path / "in", spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    shutil.copytree("/root/testdata/sf0.001", d)
    before = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        scan = spark.read.parquet(f"{d}/customer.parquet")
        assert scan.rdd.getNumPartitions() >= cores
        assert scan.select(F.spark_partition_id()).distinct().count() == 1
        for name in ("prof_page_40003", "prof_page_40005", "art_page_40003"):
            walked = QUERIES[name](spark, str(d))
            assert walked.select(F.spark_partition_id()).distinct().count() >= cores, name
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["feed_blog_table", "prof_page_40003", "prof_page_40005", "art_page_40003"])
def test_pages_of_users_in_one_split_are_walked_by_all_cores(spark, name):
    from feedlake.plans.catalog import QUERIES
    d = "/root/testdata/sf0.001"
    assert spark.read.parquet(f"{d}/customer.parquet").rdd.getNumPartitions() == 1
    assert QUERIES[name](spark, d).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def _walks_in_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def test_author_pages_are_spread_and_walked_once(spark):
    """The filter Spark infers for ``explode`` does not walk the pages a second time."""
    from feedlake.operators import article_pages as ap
    from feedlake.sources import site_pages as site
    pages = site.author_pages(spark, "/root/testdata/sf0.001")
    assert pages.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    read = ap.author_links(pages.select(F.col("row_key").alias("page_url"), "html"))
    assert _walks_in_plan(read.select(F.explode("links").alias("l"))) == 1


def test_texts_are_read_once_in_bounded_batches(spark):
    from feedlake.operators import text as tx
    from feedlake.plans import enrich
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for make in (lambda: enrich.cuts(enrich.digests(docs)), lambda: tx.term_counts(docs)):
        spark.conf.unset(key)
        df = make()
        assert _walks_in_plan(df) == 1 and spark.conf.get(key) == "4m"


@pytest.mark.parametrize("name, walks", [("nlp_stock_string", 0), ("nlp_sentiment", 1)])
def test_digests_of_all_branches_are_made_once(spark, name, walks):
    """What is left in the plan are the term counts of the digests."""
    from feedlake.plans.catalog import QUERIES
    assert _walks_in_plan(QUERIES[name](spark, "/root/testdata/sf0.001")) == walks
