"""Hot-key inputs: one page holds a third of all items. The take-while and
keep-N operators are run with AQE's skew thresholds lowered so the skewed
join / aggregation paths actually execute, and compared with plain Python."""
import contextlib
import io
import random

from pyspark.sql import functions as F

from feedlake.operators import graph
from feedlake.operators import increments as inc
from feedlake.operators import sinks


def _skewed_feed(n_pages=60, per_page=20, hot=1800, seed=7):
    rnd = random.Random(seed)
    rows = []
    for p in range(n_pages):
        n = hot if p == 0 else per_page
        for i in range(n):
            rows.append((f"p{p}", i, f"k{rnd.randint(0, 40)}"))
    markers = {f"p{p}": f"k{rnd.randint(0, 60)}" for p in range(n_pages) if p % 3}
    return rows, markers


def _py(rows, markers):
    out = {}
    for page in sorted({r[0] for r in rows}):
        items = sorted((r for r in rows if r[0] == page), key=lambda r: r[1])
        kept = []
        for _, pos, key in items:
            if markers.get(page) is not None and key == markers[page]:
                break
            kept.append(pos)
        if kept:
            out[page] = kept
    return out


@contextlib.contextmanager
def _small_thresholds(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()                      # final adaptive plan after execution
    return buf.getvalue()


def test_take_until_seen_hot_page(spark):
    rows, marks = _skewed_feed()
    with _small_thresholds(spark):
        items = spark.createDataFrame(rows, "page string, pos int, key string")
        m = spark.createDataFrame(list(marks.items()), "page string, last_key string")
        df = inc.take_until_seen(items, m, "page", F.col("pos"), "key", "last_key")
        got = {}
        for r in df.collect():
            got.setdefault(r.page, []).append(r.pos)
        assert {p: sorted(v) for p, v in got.items()} == _py(rows, marks)
        assert "skew=true" in _plan(df)   # the hot page was split, not sent to one task


def test_take_while_newer_hot_page_and_aggregated_markers(spark):
    """The marker side comes out of an aggregation on the page key."""
    rows = [("hot" if i % 3 else f"p{i % 60}", i, 10_000 - i) for i in range(6000)]
    seen = [(p, t) for p, _, t in rows if t % 1000 == 0]
    with _small_thresholds(spark):
        items = spark.createDataFrame(rows, "page string, pos int, ts int")
        m = spark.createDataFrame(seen, "page string, t int").groupBy("page").agg(F.min("t").alias("last_ts"))
        df = inc.take_while_newer(items, m, "page", F.col("pos"), "ts", "last_ts")
        got = {(r.page, r.pos) for r in df.collect()}
        last = {}
        for p, t in seen:
            last[p] = min(t, last.get(p, t))
        assert got == {(p, i) for p, i, t in rows if t > last.get(p, 0)}
        assert "skew=true" in _plan(df)


def test_friends_of_hot_account(spark):
    """The frontier comes out of a semi join on the account id."""
    edges = [(0, i) for i in range(1, 4000)] + [(i % 300, i) for i in range(4000)]
    with _small_thresholds(spark):
        e = spark.createDataFrame(edges, "src long, dst long")
        pages = spark.range(0, 200).toDF("user_id")
        front = spark.range(0, 300).toDF("user_id").join(pages, "user_id", "left_semi")
        df = graph.friends_of(front, e)
        assert sorted(r.user_id for r in df.collect()) == sorted(d for s, d in edges if s < 200)
        assert "skew=true" in _plan(df)


def test_keep_versions_hot_key(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"c{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, ts int")
    got = sorted((r.key, r.ts) for r in sinks.keep_versions(df, "key", F.col("ts"), 3).collect())
    assert [t for k, t in got if k == "hot"] == [2997, 2998, 2999]
    assert len(got) == 3 + 200
