"""Keyed logs and bucketed tables: what they hold, what they read and rewrite, replay."""
import os
import random

from feedlake.operators.keyed_tables import BucketTable, KeyedLog, bucket_of


def log(spark, path, **kw):
    return KeyedLog(spark, str(path), {"k": "string"}, {"v": "string"}, **{"buckets": 4, "epoch": 3, **kw})


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_log_state_snapshots_and_replay(spark, tmp_path):
    """Random runs with gaps: the state before each run is that of a dict; few folders."""
    rnd, t, want, states = random.Random(3), log(spark, tmp_path / "log"), {}, {}
    runs = [-1, 0, 1, 2, 4, 5, 6, 13, 14]
    changes = {r: {rnd.choice("abcdef"): f"{r}-{i}" for i in range(3)} for r in runs}
    for r in runs:
        states[r] = set(want.items())
        assert rows(t.state(r)) == states[r]
        t.write(spark.createDataFrame(list(changes[r].items()), "k string, v string"), r)
        want.update(changes[r])
        assert len(t._folders(r + 1)) <= 2 * t.epoch + 1
    assert rows(t.state(100)) == set(want.items())
    for r in (5, 13):   # a replayed run sees what it saw the first time
        assert rows(t.state(r)) == states[r]
        t.write(spark.createDataFrame(list(changes[r].items()), "k string, v string"), r)
    assert rows(t.state(100)) == set(want.items())


def test_log_reads_only_asked_buckets(spark, tmp_path):
    t = log(spark, tmp_path / "log", buckets=8)
    keys = spark.createDataFrame([(f"k{i}", "x") for i in range(60)], "k string, v string")
    t.write(keys, 0)
    one = keys.where("k = 'k7'")
    b = one.select(bucket_of(["k"], 8)).first()[0]
    read = t.rows(1, [b])
    assert {os.path.basename(os.path.dirname(f)) for f in read.inputFiles()} != set()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "key_bucket" in plan.split("PartitionFilters")[1]
    assert rows(t.state(1, one).select("k")) == rows(keys.where(bucket_of(["k"], 8) == b).select("k"))
    assert rows(t.absent(spark.createDataFrame([("k7", "y"), ("new", "y")], "k string, v string"), 1)) == {("new", "y")}
    assert rows(t.state(1, keys.limit(0))) == set()


def test_log_many_runs_open_few_folders(spark, tmp_path):
    """Folders opened do not grow with the number of runs (empty deltas stand in for runs)."""
    t = log(spark, tmp_path / "log", epoch=20)
    for e in range(50):
        for r in range(20 * e, 20 * e + 20):
            os.makedirs(tmp_path / "log" / f"epoch={e}" / f"part={r}")
        if e:
            os.makedirs(tmp_path / "log" / f"epoch={e}" / "part=snapshot")
            (tmp_path / "log" / f"epoch={e}" / "part=snapshot" / "_SUCCESS").touch()
    assert len(t._folders(1000)) <= 21 and len(t._folders(999)) == 20 and len(t._folders(21)) == 2


def test_log_removal(spark, tmp_path):
    t = KeyedLog(spark, str(tmp_path / "seen"), {"url": "string"}, {"gone": "boolean"}, removed="gone", buckets=4, epoch=2)
    put = lambda r, *x: t.write(spark.createDataFrame(list(x), "url string, gone boolean"), r)
    put(0, ("a", False), ("b", False))
    put(1, ("a", True))
    assert rows(t.state(2).select("url")) == {("b",)}
    put(2, ("a", False))     # its snapshot no longer holds the removed key
    assert rows(t.state(2).select("url")) == {("b",)} and rows(t.state(3).select("url")) == {("a",), ("b",)}


def folders(path):
    return {(v, b) for v in os.listdir(path / "data") for b in os.listdir(path / "data" / v) if "=" in b}


def test_bucket_table_rewrites_touched_buckets_only(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), ["k"], "k int, v string, w int", 8)
    t.create(spark.createDataFrame([(i, f"v{i}", i) for i in range(100)], "k int, v string, w int"))
    assert len(folders(tmp_path / "t")) == 8
    upd = spark.createDataFrame([(5, None), (1000, "nobody")], "k int, v string")
    touched = {r[0] for r in upd.select(bucket_of(["k"], 8)).collect()}
    for _ in range(2):       # replayed
        t.update(upd, ["v"], 1)
        made = {b for v, b in folders(tmp_path / "t") if v == "version=1"}
        assert made == {f"key_bucket={b}" for b in touched}
    want = {(i, None if i == 5 else f"v{i}", i) for i in range(100)}
    assert rows(t.current()) == want and rows(t.current(1)) == {(i, f"v{i}", i) for i in range(100)}
    # a write without its manifest (a lost driver) is not seen
    os.remove(tmp_path / "t" / "manifest" / "version=1" / "_SUCCESS")
    assert rows(t.current()) == {(i, f"v{i}", i) for i in range(100)}
    t.update(upd, ["v"], 1)
    assert rows(t.current()) == want


def test_bucket_table_puts(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "kv"), ["k"], "k string, v string, o int", 4)
    put = lambda n, *x: t.put(spark.createDataFrame(list(x), "k string, v string, o int"), "o", n)
    assert rows(t.current()) == set()
    put(0, ("x", "1", 5), ("x", "0", 3))
    for _ in range(2):
        put(1, ("x", "late", 4), ("y", "2", 1))
    put(2, ("y", None, 9))
    assert rows(t.current()) == {("x", "1", 5), ("y", None, 9)}
    assert rows(t.current(2)) == {("x", "1", 5), ("y", "2", 1)}
