"""Graph BFS against a Python BFS on random graphs; digest and naive Bayes
on hand-written documents."""
import math
import re
from collections import Counter, deque

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.operators import graph
from feedlake.operators import text as tx


def _py_bfs(seeds, edges, followers, pages, gate):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, set()).add(d)
    hop = {s: 0 for s in seeds}
    q = deque(s for s in seeds if s in pages)
    while q:
        u = q.popleft()
        for v in sorted(adj.get(u, ())):
            if v not in hop and gate(followers[v]):
                hop[v] = hop[u] + 1
                if v in pages:
                    q.append(v)
    return hop


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), min_size=1, max_size=40),
       st.lists(st.integers(0, 300), min_size=15, max_size=15),
       st.sets(st.integers(0, 14), min_size=1, max_size=12))
def test_bfs_matches_python(spark, edges, followers, pages):
    edges = [(s, d) for s, d in edges if s != d] or [(0, 1)]
    e = spark.createDataFrame(edges, "src long, dst long")
    n = spark.createDataFrame(list(enumerate(followers)), "user_id long, followers long")
    p = spark.createDataFrame([(x,) for x in pages], "user_id long")
    s = spark.createDataFrame([(0,)], "user_id long")
    got = {r.user_id: r.hop for r in graph.expand(s, e, n, p, save_gate=F.col("followers") > 100).collect()}
    want = _py_bfs([0], edges, followers, pages, lambda f: f > 100)
    assert got == want


def test_bfs_runs_to_the_end_of_a_long_chain(spark):
    n = 54
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "src long, dst long").coalesce(1)
    nodes = spark.createDataFrame([(i, 200) for i in range(n + 1)], "user_id long, followers long").coalesce(1)
    s = nodes.where("user_id = 0").select("user_id")
    assert {r.user_id: r.hop for r in graph.expand(s, e, nodes, nodes).collect()} == {i: i for i in range(n + 1)}
    with pytest.raises(ValueError):
        graph.expand(s, e, nodes, nodes, max_rounds=3)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="天地ひカ々〇⺀ー゙aé1 .-İß𠀀😀", max_size=30))
def test_counts_of_equals_the_tokens(text):
    assert tx.counts_of(text) == Counter(tx.tokens_of(text))


def test_token_stats_leave_the_scan_counted(spark):
    docs = spark.createDataFrame([(1, "天地天地 b2 b2"), (1, "天地"), (2, "天"), (None, "天地"), (3, None)], "doc_id long, text string")
    got = {r.token: (r.n, r.n_docs) for r in tx.token_stats(docs).collect()}
    assert got == {"天地": (4, 1), "地天": (1, 1), "b2": (2, 1), "天": (1, 1)}
    from feedlake.plans.q_text import q_nlp_tokens_unspaced
    from .conftest import SF0001
    plan = q_nlp_tokens_unspaced(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "explode" not in plan   # no row for every occurrence


def test_digest_and_nb(spark):
    docs = spark.createDataFrame([
        (1, "Markets rose today. Markets rose again on strong demand. The weather was fine. Demand stays strong!"),
        (2, ""),
        (3, "One sentence only"),
    ], "doc_id long, text string")
    dg = {r.doc_id: r.digest for r in docs.select("doc_id", tx.digest("text", k=2).alias("digest")).collect()}
    assert dg[1] == "Markets rose today. Markets rose again on strong demand."
    assert dg[2] is None and dg[3] == "One sentence only"
    train = spark.createDataFrame([(1, "good great fine", "pos"), (2, "bad awful poor", "neg"),
                                   (3, "great good", "pos")], "doc_id long, text string, label string")
    tf = tx.term_counts(train, keep=("label",))
    model, classes = tx.nb_train(tf, train.select("doc_id", "label"))
    test = spark.createDataFrame([(10, "good good fine"), (11, "awful poor"), (12, "unknown words")],
                                 "doc_id long, text string")
    pred = {r.doc_id: r.predicted for r in tx.nb_predict(tx.term_counts(test), model, classes,
                                                         test).collect()}
    assert pred == {10: "pos", 11: "neg", 12: "pos"}   # unknown words -> prior (2 of 3 pos)


def test_scores_do_not_depend_on_where_weights_lie(spark, monkeypatch):
    """Weights that all tasks hold, those of no token, and those of frequent tokens only
    give the same scores; then a frequent token's counts are summed before a shuffle."""
    words = ["often"] * 8 + ["common"] * 4 + ["some", "some", "rare", "seldom", "once"]
    rows = [(i, " ".join(words[i % 5:i % 5 + 9]) + f" own{i} own{i % 7}", "abc"[i % 3]) for i in range(40)]
    docs = spark.createDataFrame([*rows, (40, "", "a"), (41, "unknown words", None), (42, None, "b")],
                                 "doc_id long, text string, label string")
    model, classes = tx.nb_train(tx.term_counts(docs.where("doc_id <> 41"), keep=("label",)),
                                 docs.where("doc_id <> 41").select("doc_id", "label"))
    got, plans = [], []
    for most in (1 << 20, 0, 6 * (8 * 3 + 48)):
        monkeypatch.setattr(tx, "MOST_WEIGHT_BYTES", most)
        pred = tx.nb_predict(tx.term_counts(docs), model, classes, docs)
        plans.append(pred._jdf.queryExecution().executedPlan().toString())
        got.append({r.doc_id: (r.predicted, round(r.score, 9)) for r in pred.collect()})
    assert len(got[0]) == 43 and got[0] == got[1] == got[2]
    held = r"BroadcastHashJoin \[token#\d+\], \[token#\d+\], LeftOuter"
    assert re.search(held, plans[2]) and "SortMergeJoin [token" in plans[2]


def _digest_by_definition(text, k):
    low = [(i, s, tx.tokens_of(s)) for i, s in enumerate(re.findall(tx.SENTENCE, text))]
    counts = Counter(t for _, _, ts in low for t in ts)
    scored = sorted((-math.floor(sum(counts[t] for t in ts) / len(ts) * 1e6 + 0.5), i, s) for i, s, ts in low if ts)[:k]
    return " ".join(s.strip(" ") for _, _, s in sorted(scored, key=lambda x: x[1])) if scored else None


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é.!?\n-天ſİΣ9²_", max_size=60), st.integers(1, 4))
def test_digest_is_that_of_its_definition(text, k):
    assert tx.digest_of(text, k) == _digest_by_definition(text, k)


def test_ordinary_texts_take_the_fast_way(monkeypatch):
    """Below the first character of ``_BEYOND`` both ways find the same tokens, and such
    texts never take the slow one."""
    chars = "".join(c + "x " for c in map(chr, range(0x530)))
    slow = tx._TOKEN.findall(chars.lower())
    monkeypatch.setattr(tx, "_TOKEN", None)
    monkeypatch.setattr(tx, "_UNSPACED", None)
    # a lower-case letter beyond it (of U+023A and U+023E) sends a text the slow way
    assert [t for c in chars.split(" ") if not tx._BEYOND.search(c.lower()) for t in tx.tokens_of(c)] == [
        t for t in slow if not tx._BEYOND.search(t)]
    assert tx.counts_of("Grüße, naïve Grüße") == {"grüße": 2, "naïve": 1}
    assert tx.digest_of("Déjà vu. Ça va!", 1) == "Déjà vu."
