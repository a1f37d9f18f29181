"""Flagship stream: two runs over one checkpoint emit only what is new;
a third run without new notices emits nothing."""
import json
import tempfile

from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.streaming import feed


def _page(items):
    lis = "".join(f'<li><div class="UserBox"><a class="Name" href="/u/7">n</a><a class="Tit" href="http://blog.example/{k}">'
                  f'{k}</a></div><div class="HandleBox"><span>1</span><span>a 2</span><span>b 3</span></div></li>'
                  for k in items)
    return f'<html><div id="Tab1"><div class="TabItem"><ul>{lis}</ul></div></div></html>'


def _store(spark, html):
    return spark.createDataFrame([("40002", "http://blog.example/7", "http://blog.example/7", html)],
                                 "table_name string, row_key string, url string, html string")


def _notice(path, seq):
    with open(path, "w") as f:
        f.write(json.dumps({"msg_seq": seq, "value": json.dumps(
            {"attr_id": "40002", "key_name": "40002", "pos_name": "http://blog.example/7"})}) + "\n")


def _run(spark, src, store, out, ck):
    notices = spark.readStream.schema("msg_seq long, value string").json(src)
    markers = spark.createDataFrame([], "page_url string, last_key string")
    q = feed.start(spark, notices, store, schemas.platforms(spark), markers, out, ck, available_now=True)
    q.awaitTermination()
    try:
        return sorted(r.title for r in spark.read.parquet(f"{out}/articles").collect())
    except Exception:  # noqa: BLE001 - no output folder yet
        return []


def test_restart_emits_only_new(spark):
    root = tempfile.mkdtemp(prefix="feedlake-stream-")
    src, ck = f"{root}/src", f"{root}/ckpt"
    import os
    os.makedirs(src)
    _notice(f"{src}/a.json", 1)
    got1 = _run(spark, src, _store(spark, _page(["a", "b", "c"])), f"{root}/out1", ck)
    assert got1 == ["a", "b", "c"]
    _notice(f"{src}/b.json", 2)
    got2 = _run(spark, src, _store(spark, _page(["d", "e", "a", "b", "c"])), f"{root}/out2", ck)
    assert got2 == ["d", "e"]
    got3 = _run(spark, src, _store(spark, _page(["d", "e", "a", "b", "c"])), f"{root}/out3", ck)
    assert got3 == []
    tasks = spark.read.text(f"{root}/out2/tasks").collect()
    assert sorted(json.loads(t.value)["url"] for t in tasks) == ["http://blog.example/d", "http://blog.example/e"]


def test_article_on_two_pages_is_written_once_and_rejects_are_kept(spark):
    """The second page lists an article of the first; a later batch lists it again."""
    import os
    root = tempfile.mkdtemp(prefix="feedlake-once-")
    os.makedirs(f"{root}/src")
    rows = [("40002", f"http://blog.example/{i}", f"http://blog.example/{i}", _page(["x", f"own{i}"])) for i in (7, 8, 9)]
    store = spark.createDataFrame(rows, "table_name string, row_key string, url string, html string")
    empty = spark.createDataFrame([], "page_url string, last_key string")

    def run(ids, extra=()):
        with open(f"{root}/src/{ids[0]}.json", "w") as f:
            for i in ids:
                f.write(json.dumps({"msg_seq": i, "value": json.dumps(
                    {"attr_id": "40002", "key_name": "40002", "pos_name": f"http://blog.example/{i}"})}) + "\n")
            for v in extra:
                f.write(json.dumps({"msg_seq": 0, "value": v}) + "\n")
        notices = spark.readStream.schema("msg_seq long, value string").json(f"{root}/src")
        feed.start_rejects(notices, schemas.platforms(spark), f"{root}/out", f"{root}/ck-r", True).awaitTermination()
        feed.start(spark, notices, store, schemas.platforms(spark), empty, f"{root}/out", f"{root}/ck", True).awaitTermination()
        return sorted(r.title for r in spark.read.parquet(f"{root}/out/articles").collect())

    assert run([7, 8], ["nonsense"]) == ["own7", "own8", "x"]
    assert run([9]) == ["own7", "own8", "own9", "x"]
    assert [r.reason for r in spark.read.parquet(f"{root}/out/rejects").collect()] == ["not_json"]


def test_marker_rules_in_arrival_order():
    from feedlake.streaming.markers import next_marker
    assert next_marker("ts", "5", "3") == "5" and next_marker("ts", "5", "9") == "9"
    assert next_marker("title", "a", "b") == "b" and next_marker("head", "a", None) == "a"
    assert next_marker("url", None, "b") == "b"


def test_two_stage_matches_single_stage(spark):
    """The pruned two-stage layout gives the flagship stream's rows on the
    sf0.001 notices, and reads only the store partitions of the batch."""
    import os

    from feedlake.plans import flagship
    from feedlake.sources import page_store as ps
    from feedlake.sources import standins
    root = tempfile.mkdtemp(prefix="feedlake-2stage-")
    d = "/root/testdata/sf0.001"
    store = standins.feed_store(spark, d)
    ps.write_store(store.select("table_name", "row_key", "url", "html"),
                   f"{root}/store", buckets=16)
    standins.messages(spark, d, store).write.json(f"{root}/notices")
    notices = spark.readStream.schema("msg_seq long, value string").json(f"{root}/notices")
    qa, qb = feed.start_two_stage(spark, notices, f"{root}/store", schemas.platforms(spark),
                                  flagship.page_markers(spark, d), f"{root}/work", f"{root}/out",
                                  buckets=16, available_now=True)
    qb.awaitTermination()
    got = spark.read.parquet(f"{root}/out/articles").drop("batch")
    want = flagship.feed_increments(spark, d)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    # pruning: a lookup for one key reads one partition
    one = spark.createDataFrame([("40001", "x")], "key_name string, pos_name string")
    pruned = ps.read_for_keys(spark, f"{root}/store", one, "pos_name", 16)
    pruned.createOrReplaceTempView("pruned_store")
    plan = spark.sql("EXPLAIN SELECT * FROM pruned_store").first()[0]
    part = [ln for ln in plan.splitlines() if "PartitionFilters" in ln]
    assert part and "key_bucket" in part[0]
    assert os.path.isdir(f"{root}/store")


def test_batch_runs_with_marker_table(spark):
    """Two scheduled runs over the same notices: the second finds nothing new;
    re-running run 1 reproduces run 1 (it reads markers before run 1)."""
    from feedlake.plans import flagship
    from feedlake.sources import standins
    d = "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="feedlake-runs-")
    store = standins.feed_store(spark, d)
    args = (standins.messages(spark, d, store), store, schemas.platforms(spark), root)
    flagship.run_increment(spark, *args, 1, flagship.page_markers(spark, d))
    first = spark.read.parquet(f"{root}/articles/run=1").count()
    assert first == flagship.feed_increments(spark, d).count() > 0
    flagship.run_increment(spark, *args, 2)
    assert spark.read.parquet(f"{root}/articles/run=2").count() == 0
    flagship.run_increment(spark, *args, 1, flagship.page_markers(spark, d))
    assert spark.read.parquet(f"{root}/articles/run=1").count() == first


def test_many_micro_batches_equal_batch(spark):
    """Notices spread over several files, one file per trigger: state carried
    across micro-batches gives exactly the batch flagship's rows (a page
    announced again in a later batch adds nothing)."""
    from feedlake.plans import flagship
    from feedlake.sources import standins
    d = "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="feedlake-multi-")
    store = standins.feed_store(spark, d)
    msgs = standins.messages(spark, d, store).withColumn("part", F.col("msg_seq") % 4)
    msgs.write.partitionBy("part").json(f"{root}/notices")
    notices = (spark.readStream.schema("msg_seq long, value string").option("maxFilesPerTrigger", 1)
               .option("recursiveFileLookup", "true").json(f"{root}/notices"))
    q = feed.start(spark, notices, store, schemas.platforms(spark),
                   flagship.page_markers(spark, d), f"{root}/out", f"{root}/ck", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/out/articles")
    assert got.select("batch").distinct().count() > 1           # really several micro-batches
    got = got.drop("batch")
    want = flagship.feed_increments(spark, d)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def _walks(spark, root, batches, ttl_days=90, pause=0.0):
    """One stream run per (notice number, items on the page); titles in the order written."""
    import os
    import time
    os.makedirs(f"{root}/src")
    titles = []
    for n, (seq, items) in enumerate(batches):
        _notice(f"{root}/src/{n}.json", seq)
        notices = spark.readStream.schema("msg_seq long, value string").json(f"{root}/src")
        seeds = spark.createDataFrame([("http://blog.example/7", "old")], "page_url string, last_key string")
        feed.start(spark, notices, _store(spark, _page(items)), schemas.platforms(spark), seeds, f"{root}/out{n}",
                   f"{root}/ck", available_now=True, ttl_days=ttl_days).awaitTermination()
        titles.append(sorted(r.title for r in spark.read.schema("title string").parquet(f"{root}/out{n}/articles").collect()))
        time.sleep(pause)
    return titles


def test_late_notice_moves_no_marker(spark):
    """Number 5 arrives after 9: it yields nothing, and the next walk still stops at
    the marker that 9 left."""
    got = _walks(spark, tempfile.mkdtemp(prefix="feedlake-late-"),
                 [(9, ["c", "b", "a", "old"]), (5, ["b", "a", "old"]), (12, ["d", "c", "b", "a"])])
    assert got == [["a", "b", "c"], [], ["d"]]


def test_marker_expires(spark):
    """After its time to live a page has no marker, and all its items are new again."""
    got = _walks(spark, tempfile.mkdtemp(prefix="feedlake-ttl-"), [(1, ["b", "a", "old"]), (2, ["b", "a"])],
                 ttl_days=1 / 86400, pause=2.0)
    assert got == [["a", "b"], ["a", "b"]]


def test_walk_pairs_snapshots_in_order():
    from feedlake.streaming.markers import walk
    rows = [dict(msg_seq=s, marker_kind="url", newest=n) for s, n in ((3, "c"), (1, "a"), (2, None), (3, "again"))]
    taken, seq, last = walk(rows, None, "seed")
    assert [(r["msg_seq"], before) for r, before in taken] == [(1, "seed"), (2, "a"), (3, "a")]
    assert (seq, last) == (3, "c")
    assert walk(rows, 3, "c") == ([], 3, "c")


def test_record_order(spark):
    from feedlake.sources.tables import record_order
    rows = [(1_700_000_000_000, 0, 999), (1_700_000_000_000, 0, 1000), (1_700_000_000_000, 1, 0), (1_700_000_000_001, 0, 3),
            (1_700_000_000_001, 99_999, 2**63 - 1)]
    df = spark.createDataFrame(rows, "ms long, p int, o long").selectExpr("timestamp_millis(ms) t", "p", "o")
    got = [r.k for r in df.select(record_order("t", "p", "o").alias("k")).collect()]
    assert got == sorted(set(got)) and None not in got


def test_address_on_two_platforms_keeps_two_markers(spark):
    """A title marker and a time marker under one address: each page is walked against
    its own, and the time is not read from the other's title."""
    import os
    root, url = tempfile.mkdtemp(prefix="feedlake-shared-"), "http://shared.example/7"
    os.makedirs(f"{root}/src")
    record = [{"actionName": "R", "actionID": str(i), "objectID": "7", "userID": "7", "userName": "u7",
               "actionDate": f"2016-07-14 0{i}:00", "OtherID": str(i), "body": "b"} for i in (3, 2, 1)]
    store = spark.createDataFrame([("40002", url, url, _page(["new", "seen"])), ("40004", url, url, json.dumps({"record": record}))],
                                  "table_name string, row_key string, url string, html string")
    seeds = spark.createDataFrame([(40002, url, "seen"), (40004, url, "1468432800000")],   # 02:00 in Shanghai
                                  "platform_id int, page_url string, last_key string")
    with open(f"{root}/src/a.json", "w") as f:
        for seq, p in ((1, "40002"), (2, "40004"), (3, "40002"), (4, "40004")):
            f.write(json.dumps({"msg_seq": seq, "value": json.dumps({"attr_id": p, "key_name": p, "pos_name": url})}) + "\n")
    notices = spark.readStream.schema("msg_seq long, value string").json(f"{root}/src")
    q = feed.start(spark, notices, store, schemas.platforms(spark), seeds, f"{root}/out", f"{root}/ck", True)
    q.awaitTermination()
    got = {(r.platform_id, r.url) for r in spark.read.parquet(f"{root}/out/articles").collect()}
    assert got == {(40002, "http://blog.example/new"), (40004, "http://www.taoguba.com.cn/Article/7/3")}


def test_time_marker_after_a_text():
    from feedlake.streaming.markers import next_marker
    assert next_marker("ts", "a title", "9") == "9" and next_marker("ts", "9", "a title") == "9"
    assert next_marker("ts", "gone", None) is None and next_marker("ts", "7", None) == "7"
