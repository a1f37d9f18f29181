"""Sinks: keyed updates write NULL when matched, insert-if-absent, and the
salted top-N equals a plain per-key window."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlake.operators import sinks


def test_keyed_update_writes_null(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k int, v string, w string")
    u = spark.createDataFrame([(1, None), (3, "C")], "k int, v string")
    got = {r.k: (r.v, r.w, r.updated) for r in sinks.keyed_update(t, u, ["k"], ["v"]).collect()}
    assert got == {1: (None, "x", True), 2: ("b", "y", False), 3: ("C", "z", True)}


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([("u1",)], "url string")
    incoming = spark.createDataFrame([("u1", 1), ("u2", 2), ("u2", 2), ("u3", 3)], "url string, p int")
    assert sorted(r.url for r in sinks.insert_if_absent(incoming, existing, ["url"]).collect()) == ["u2", "u3"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 1000)), min_size=1, max_size=200, unique_by=lambda x: x[1]),
       st.integers(1, 4))
def test_top_n_salted_equals_window(spark, rows, n):
    df = spark.createDataFrame(rows, "key string, ts int")
    got = sorted((r.key, r.ts) for r in sinks.keep_versions(df, "key", F.col("ts"), n).collect())
    w = Window.partitionBy("key").orderBy(F.col("ts").desc())
    want = sorted((r.key, r.ts) for r in df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).collect())
    assert got == want


def test_article_views_prune_and_rename(spark, tmp_path):
    from feedlake.plans import views
    rows = [(40004, "u1", "t1", "http://a/1", 10, "s1", {"recommend": 3, "read": 40}),
            (40001, "u2", "t2", "http://a/2", 11, None, {"retweet": 1})]
    df = spark.createDataFrame(rows, "platform_id int, user_id string, title string, url string, ts long, "
                                     "summary string, metrics map<string,bigint>")
    sinks.append(df, str(tmp_path / "articles"), ["platform_id"])
    table = spark.read.parquet(str(tmp_path / "articles"))
    v = views.article_view(table, 40004)
    assert v.columns == views.ARTICLE_VIEWS[40004]
    assert [tuple(r) for r in v.collect()] == [("u1", "t1", 3, 40, 0, "http://a/1", 10, "s1")]
    v.createOrReplaceTempView("v40004")
    plan = spark.sql("EXPLAIN SELECT * FROM v40004").first()[0]
    assert "PartitionFilters" in plan and "40004" in plan


def test_page_store_pruning(spark, tmp_path):
    from feedlake.sources import page_store as ps
    pages = spark.createDataFrame([("40001", f"k{i}", f"http://a/{i}", f"<p>{i}</p>") for i in range(40)],
                                  "table_name string, row_key string, url string, html string")
    ps.write_store(pages, str(tmp_path / "store"), buckets=8)
    keys = spark.createDataFrame([("40001", f"k{i}") for i in range(0, 40, 3)], "key_name string, pos_name string")
    pruned = ps.read_for_keys(spark, str(tmp_path / "store"), keys, "pos_name", 8)
    none = ps.read_for_keys(spark, str(tmp_path / "store"), keys.limit(0), "pos_name", 8)
    got = lambda s: sorted(r.row_key for r in s.join(keys, s.row_key == keys.pos_name, "left_semi").collect())
    assert got(pruned) == sorted(f"k{i}" for i in range(0, 40, 3))
    assert none.count() == 0 and pruned.count() <= 40


def test_profile_view(spark):
    from feedlake.plans import views
    prof = spark.createDataFrame([(40005, 7, 120, "n", "hi", "http://h", "p.png", "1"),
                                  (40002, 8, 5, "m", "yo", "http://g", "q.png", "0")],
                                 "platform_id int, user_id long, followers_count long, name string, "
                                 "introduction string, home_page string, portrait string, official_vip string")
    v = views.profile_view(prof, 40005)
    assert v.columns == views.PROFILE_VIEWS[40005]
    assert [tuple(r) for r in v.collect()] == [(7, 120, "1", "n", "hi", "http://h", "p.png")]
    assert views.profile_view(prof, 40002).first()["vip"] is None     # column absent -> typed NULL
