"""Take-while family against the FIXTURES vectors and a plain Python loop."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.operators import increments as inc


def _items(spark, pages):
    rows = [(p, i, k, ts) for p, items in pages.items() for i, (k, ts) in enumerate(items)]
    return spark.createDataFrame(rows, "page string, pos int, key string, ts long")


def _markers(spark, m):
    return spark.createDataFrame([(p, k, t) for p, (k, t) in m.items()],
                                 "page string, last_key string, last_ts long")


def _kept(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.page, []).append((r.pos, r.key))
    return {p: [k for _, k in sorted(v)] for p, v in out.items()}


def test_take_until_seen_vectors(spark):
    pages = {"p1": [("a", 0), ("b", 0), ("c", 0)], "p2": [("a", 0), ("b", 0), ("c", 0)],
             "p3": [("a", 0), ("b", 0), ("c", 0)], "p4": [("a", 0), ("b", 0), ("c", 0)]}
    m = _markers(spark, {"p2": ("a", 0), "p3": ("b", 0), "p4": ("z", 0)})
    got = _kept(inc.take_until_seen(_items(spark, pages), m, "page", F.col("pos"), "key", "last_key"))
    assert got == {"p1": ["a", "b", "c"], "p3": ["a"], "p4": ["a", "b", "c"]}
    new_m = {r.page: r.last_key for r in inc.update_markers(
        m, inc.take_until_seen(_items(spark, pages), m, "page", F.col("pos"), "key", "last_key"),
        "page", F.col("pos"), "key", "last_key").collect()}
    assert new_m == {"p1": "a", "p2": "a", "p3": "a", "p4": "a"}


def test_take_while_newer_vectors(spark):
    pages = {"q1": [("x9", 9), ("x7", 7), ("x8", 8)], "q2": [("y5", 5), ("y9", 9)]}
    m = _markers(spark, {"q1": ("", 7), "q2": ("", 6)})
    got = _kept(inc.take_while_newer(_items(spark, pages), m, "page", F.col("pos"), "ts", "last_ts"))
    assert got == {"q1": ["x9"]}


def _py_until_seen(keys, last):
    out = []
    for k in keys:
        if last is not None and k == last:
            break
        out.append(k)
    return out


def _py_newer(tss, last):
    out = []
    for t in tss:
        if t <= (last if last is not None else 0):
            break
        out.append(t)
    return out


page_st = st.lists(st.sampled_from("abcdef"), min_size=0, max_size=7)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(page_st, st.one_of(st.none(), st.sampled_from("abcdefz"))), min_size=1, max_size=12))
def test_take_until_seen_property(spark, spec):
    pages = {f"p{i}": [(k, 0) for k in keys] for i, (keys, _) in enumerate(spec)}
    marks = {f"p{i}": (m, 0) for i, (_, m) in enumerate(spec) if m is not None}
    if not any(pages.values()):
        return
    got = _kept(inc.take_until_seen(_items(spark, pages), _markers(spark, marks) if marks else
                                    spark.createDataFrame([], "page string, last_key string, last_ts long"),
                                    "page", F.col("pos"), "key", "last_key"))
    want = {p: _py_until_seen([k for k, _ in items], marks.get(p, (None,))[0]) for p, items in pages.items()}
    assert got == {p: v for p, v in want.items() if v}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 9), min_size=1, max_size=6), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=10))
def test_take_while_newer_property(spark, spec):
    pages = {f"q{i}": [(str(t), t) for t in tss] for i, (tss, _) in enumerate(spec)}
    marks = {f"q{i}": ("", m) for i, (_, m) in enumerate(spec) if m is not None}
    mdf = _markers(spark, marks) if marks else spark.createDataFrame([], "page string, last_key string, last_ts long")
    df = inc.take_while_newer(_items(spark, pages), mdf, "page", F.col("pos"), "ts", "last_ts")
    got = {}
    for r in df.collect():
        got.setdefault(r.page, []).append((r.pos, r.ts))
    got = {p: [t for _, t in sorted(v)] for p, v in got.items()}
    want = {p: _py_newer([t for _, t in items], marks.get(p, ("", None))[1]) for p, items in pages.items()}
    assert got == {p: v for p, v in want.items() if v}


def test_page_changed_and_argmax(spark):
    pages = {"w1": [("u1", 3), ("u2", 5), ("bad", 5), ("u4", 1)], "w2": [("v1", 1)]}
    items = _items(spark, pages)
    m = _markers(spark, {"w2": ("v1", 0)})
    got = _kept(inc.page_changed(items, m, "page", F.col("pos"), "key", "last_key",
                                 valid=F.col("key") != "bad"))
    assert got == {"w1": ["u1", "u2"]}
    best = {r.page: r.key for r in inc.argmax_latest(items, "page", "ts", F.col("pos"), ["key"]).collect()}
    assert best == {"w1": "u2", "w2": "v1"}


def test_not_in_three_valued(spark):
    from feedlake.operators.relational import not_in
    o = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    inner = spark.createDataFrame([(2,)], "k int")
    assert sorted(r.k for r in not_in(spark, o, inner, "k").collect()) == [1]
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert not_in(spark, o, with_null, "k").count() == 0
    empty = spark.createDataFrame([], "k int")
    assert not_in(spark, o, empty, "k").count() == 3
