"""Driver contract and an oracle check of every registered query at sf0.001."""
import collections

import duckdb

import __spark_entry__ as E
from feedlake.plans.catalog import ORACLE as CORE_SQL
from feedlake.plans.catalog import QUERIES as CORE
from feedlake.sources.tables import TABLES

from .conftest import SF0001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["platform_id", "url", "page_url", "pos", "user_id", "title", "ts", "reposts", "comments",
                          "likes", "task"]
    assert df.count() > 0


def test_registry_contract():
    qs, orc = E.queries(), E.oracle_sql()
    assert len(CORE) >= 120 and set(CORE) <= set(qs)
    assert set(orc) <= set(qs)


def _norm(v):
    if isinstance(v, float):
        return 0.0 if round(v, 6) == 0 else round(v, 6)
    return v


def test_all_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    bad = []
    for name, fn in CORE.items():
        df = fn(spark, SF0001)
        rows = df.collect()
        sql = CORE_SQL.get(name)
        if sql is None:
            continue
        res = con.execute(sql)
        cols = [c[0] for c in res.description]
        if sorted(cols) != sorted(df.columns):
            bad.append((name, "columns"))
            continue
        si = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
        di = sorted(range(len(cols)), key=lambda i: cols[i])
        s = collections.Counter(tuple(_norm(r[i]) for i in si) for r in rows)
        d = collections.Counter(tuple(_norm(r[i]) for i in di) for r in res.fetchall())
        if s != d:
            bad.append((name, "values"))
    assert bad == []


def test_cli_lists_queries_and_aliases(capsys):
    from feedlake.__main__ import JOBS, main
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert all(alias in out for alias in JOBS) and all(n in out for n in CORE)
    assert set(JOBS.values()) <= set(CORE)


def test_bench_prints_one_json_line(spark, capsys, monkeypatch):
    import json

    import bench
    monkeypatch.setenv("BENCH_SF_DIR", SF0001)
    monkeypatch.setenv("BENCH_WARMUP_DIR", "/nonexistent")
    bench.main()
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and set(rec["queries"]) == set(bench.HEADLINE)
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
