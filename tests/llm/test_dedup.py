"""SimHash components and substring dedup against brute force."""
import collections
import hashlib
import random
import re

import numpy as np
import xxhash

from feedlake.llm import components, queries, simhash, substring
from feedlake.llm.bktree import Forest, spanning
from tests.conftest import SF0001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text, width=4):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def unite(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return [root(i) for i in range(n)]


def brute_components(fps, radius=4):
    return unite(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius])


def test_fingerprint_cases():
    texts = ["", "  \n", "One", "one two three", "A B c d", "É é É é É", "x " * 70_000,
             " ".join(str(i % 977) for i in range(70_000))]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == brute_fp(t)


def test_bk_forest_finds_all_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12).astype(np.uint64)
    values, tree = [], []
    for t, b in enumerate(base):
        own = {int(b)} | {int(b) ^ sum(1 << int(x) for x in rng.choice(64, 3)) for _ in range(rng.integers(0, 40))}
        values += own
        tree += [t] * len(own)
    values, tree = np.array(values, np.uint64), np.array(tree)
    f = Forest(values, tree)
    found = {(int(a), int(b)) for q, n in f.search(values, f.root, f.size, 4) for a, b in zip(q, n)}
    want = {(i, j) for i in range(len(values)) for j in range(len(values))
            if tree[i] == tree[j] and int(values[i] ^ values[j]).bit_count() <= 4}
    assert found == want
    a, b = spanning(len(values), f.search(values, f.root, f.size, 4))
    assert len(a) < len(values)
    assert unite(len(values), zip(a.tolist(), b.tolist())) == unite(len(values), want)


def test_links_with_split_shards(spark):
    """Shards larger than a tree are cut into trees without losing a link."""
    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        b = rng.getrandbits(64)
        fps |= {b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = brute_components([x & (2**64 - 1) for x in fps])
    at = {x: i for i, x in enumerate(fps)}
    for size in (4096, 16):
        links = [(at[r.a], at[r.b]) for r in simhash.near_links(df, tree_size=size).collect()]
        assert all(((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
        assert unite(len(fps), links) == want


def test_stars_on_chains(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(100, 200), (300, 200), (100, 300), (7, 7)]
    got = {r.node: r.root for r in components.stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 71)}, 200: 100, 300: 100}
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "extra") for i, t in texts], "doc_id long, text string, fp string")


def test_near_duplicates_cases(spark):
    rng = random.Random(5)
    long = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(400)]
    near = long[:]
    near[200] = "changed"
    texts = [(5, " ".join(long)), (3, " ".join(near)), (4, " ".join(long).upper()), (9, None), (8, ""), (7, " \n"),
             (1, "alone"), (1, "alone"), (2, "quite another text that stands by itself"), (None, " ".join(long)),
             (None, "no id here at all")]
    got = simhash.near_duplicates(docs_of(spark, texts)).collect()
    fps = [brute_fp(t) for _, t in texts]
    comp = brute_components(fps)
    least = {}
    for (i, _), c in zip(texts, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, f, least.get(c)) for (i, _), f, c in zip(texts, fps, comp)), key=str)
    assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=str) == want
    kept = simhash.first_of_each(docs_of(spark, texts)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept) == sorted(
        {least.get(c, -1) for c in set(comp)})
    assert kept[0].fp == "extra"
    assert simhash.first_of_each(docs_of(spark, texts[:6] + texts[8:9])).count() == 3
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_op9_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    fps = [brute_fp(t) for _, t in docs]
    comp = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF0001).collect()}
    assert got == {d: (f"{f:016x}", docs[c][0]) for (d, _), f, c in zip(docs, fps, comp)}


def brute_cut(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    n = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if n[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def cut(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    return [tuple(r) for r in substring.remove_repeats(df, **kw).orderBy("row.doc_id")
            .select("n_words", "n_removed", "kept").collect()]


def test_substring_cases(spark):
    rng = random.Random(9)

    def some(n, k=400):
        return " ".join(f"w{rng.randint(0, k)}" for _ in range(n))

    passage, line = some(50), some(10)
    texts = [None, "", "short", some(200), some(100) + " " + passage + "\n" + some(60), passage + "\t" + some(30),
             some(40) + " " + passage, "a " * 90, "b " * 34, some(35), some(300, 3), some(300, 3), some(20_000, 50_000)]
    texts += [texts[3]] * 3 + [texts[9]]
    texts += [some(rng.randint(0, 60)) + " " + line + " " + some(rng.randint(0, 60)) for _ in range(30)]
    want = brute_cut(texts, 35)
    assert cut(spark, texts) == want
    assert cut(spark, texts, split=5) == want     # buckets split window by window
    assert cut(spark, texts, window=9, m=3, split=8) == brute_cut(texts, 9)
    assert cut(spark, []) == []


def test_filtered_repeats_are_cut_once(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "a " * 40 + "b", 81), (2, "a " * 40 + "c", 81), (3, "alone", 5), (4, "a " * 39, 78)],
                                 "doc_id long, text string, n_chars long")
    found = corpus_pipeline.substring_dedup(spark, docs, SF0001)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, found.collect())) == [(1, "b", 1), (2, "c", 1), (3, "alone", 5)]


def test_op10_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    want = {d: (n, g, hashlib.sha256(k.encode()).hexdigest())
            for (d, _), (n, g, k) in zip(docs, brute_cut([t for _, t in docs], 35))}
    assert {r.doc_id: tuple(r)[1:] for r in queries.op10_substring(spark, SF0001).collect()} == want
