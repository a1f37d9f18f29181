"""Enrichment stream, saved models, phrases, unspaced scripts, friend lists, charsets."""
import os

from pyspark.sql import functions as F

from feedlake.operators import friend_lists
from feedlake.operators import text as tx
from feedlake.plans import enrich
from feedlake.streaming import enrichment

POSTS = [(1, "u1", "t1", 10, "alpha rises today. it rises and rises."), (2, "u2", "t2", 20, "bad losses. bad bad day."),
         (3, "u3", "t3", 30, ""), (4, "u4", "t4", 40, "--- !!"), (1, "u1", "t1", 10, "alpha rises today. it rises and rises.")]


def _models(spark, path, version, labels=(("rises alpha good", "pos"), ("bad losses", "neg"))):
    rows = [(i, text, label) for i, (text, label) in enumerate(labels)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model, classes = tx.nb_train(tx.term_counts(docs, keep=("label",)), docs.select("doc_id", "label"))
    dictionary = spark.createDataFrame([("alpha", "stock", ["alpha", "A1"]), ("day", "industry", ["day", "D"])],
                                       "term string, facet string, aliases array<string>")
    enrichment.save_models(path, version, model, classes, dictionary)


def _read(spark, out, name, *cols):
    df = spark.read.parquet(f"{out}/{name}")
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_three_tables_in_order_and_replay(spark, tmp_path):
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    _models(spark, models, 1)
    sink = enrichment.write_batch(out, models)
    batch = spark.createDataFrame(POSTS, enrichment.POST)

    def check():
        assert _read(spark, out, "articles", "url") == [("u1",), ("u2",), ("u3",), ("u4",)]
        assert _read(spark, out, "article_info", "url", "stock") == [("u1", "alpha=A1"), ("u2", ""), ("u3", "")]
        assert _read(spark, out, "news_info", "url", "stock", "industry", "sentiment") == [
            ("u1", "alpha", "", 1), ("u2", "", "day", 0), ("u3", "", "", -1)]
        assert _read(spark, out, "rejects", "doc_id", "reason") == [(4, "no_digest")]

    sink(batch, 0)
    check()
    _models(spark, models, 2, (("bad losses", "pos"), ("rises alpha good", "neg")))   # newer, the other way round
    sink(batch, 0)                              # the replay keeps its version and its rows
    check()
    sink(batch.unionByName(spark.createDataFrame([(9, "u9", "t9", 90, "bad day.")], enrichment.POST)), 1)
    assert [r[:2] for r in _read(spark, out, "news_info", "url", "sentiment", "batch")] == [
        ("u1", 1), ("u2", 0), ("u3", -1), ("u9", 1)]


def test_no_model_rejects_and_incomplete_versions(spark, tmp_path):
    """A model without classes writes no digest and no news; a version whose last part
    is missing is not used."""
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    _models(spark, models, 1, ())
    _models(spark, models, 2)
    os.remove(os.path.join(models, "version=2", "classes", "_SUCCESS"))
    assert enrichment.newest_version(spark, models) == 1
    enrichment.write_batch(out, models)(spark.createDataFrame(POSTS, enrichment.POST), 0)
    assert _read(spark, out, "rejects", "doc_id", "reason") == [(1, "no_model"), (2, "no_model"), (4, "no_digest")]
    assert _read(spark, out, "article_info", "url") == _read(spark, out, "news_info", "url") == [("u3",)]


def test_unspaced_scripts(spark):
    texts = ["天地玄黃 abc", "x天地y", "天", "カタひら3天", "plain words", "", None]
    want = [["天地", "地玄", "玄黃", "abc"], ["x", "天地", "y"], ["天"], ["カタ", "タひ", "ひら", "3", "天"], ["plain", "words"], [], None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.a for r in df.select("i", tx.token_array("t").alias("a")).orderBy("i").collect()] == want
    assert [tx.tokens_of(t) for t in texts[:-1]] == want[:-1]


def test_phrases_by_automaton_equal_the_join(spark):
    docs = spark.createDataFrame([(1, "New York city, new-york!"), (2, "newyork new"), (3, "a b a b c"), (4, ""), (5, None),
                                  (3, "repeated row: a b"), (6, "天地玄")], "doc_id long, text string")
    terms = spark.createDataFrame([("New York", "stock"), ("a b", "industry"), ("a b", "section"), ("b a b", "stock"),
                                   ("york", "section"), ("天地", "stock"), ("--", "stock")], "term string, facet string")
    want = {(1, "New York"), (1, "york"), (3, "a b"), (3, "b a b"), (6, "天地")}
    for most in (1 << 20, 0):
        assert {tuple(r) for r in tx.phrase_hits(docs, terms, most_bytes=most).collect()} == want
    assert tx.phrase_hits(docs, terms.limit(0)).count() == 0
    tags = {r.doc_id: tuple(r)[1:] for r in tx.phrase_tags(docs.where("doc_id <> 3"), terms).collect()}
    assert tags[1] == ("New York", "", "york") and tags[2] == ("", "", "")


def test_friend_lists(spark):
    pages = spark.createDataFrame([
        (1, '<root total="2"><keyword userID="7" userName="a"/><keyword userID="8"/></root>'), (2, '<root total="0"></root>'),
        (3, '<root total="1"><keyword userID="9"/>'), (4, "no list at all"), (5, '<root total="1"><keyword userID="6"/></root>'),
        (6, "")], "user_id long, xml string")
    edges, status = friend_lists.parse(pages)
    assert sorted(map(tuple, edges.collect())) == [(1, 7), (1, 8), (5, 6)]
    assert {r.user_id: r.result for r in status.collect()} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 2}


def test_posts_of_documents(spark):
    row = enrich.as_posts(spark.createDataFrame([(5, "title\nbody")], "doc_id long, text string")).first()
    assert (row.title, row.text) == ("title", "title\nbody") and row.url.endswith("5")



def test_charset_detection(spark):
    from feedlake.operators.charset import decoded
    han = "今天天气很好我们去公园看花"
    cases = [("plain", "utf-8", "utf-8"), ("Grüße, très déjà vu", "cp1252", "cp1252"), ("Grüße 天", "utf-8", "utf-8"),
             (han, "gbk", "gbk"), (han + " abc 123. " + han, "gbk", "gbk"), ("今天天氣很好我們去公園看花", "big5", "big5"), ("", "gbk", "utf-8"),
             (han * 2000, "gbk", "gbk")]
    rows = [(i, t.encode(c)) for i, (t, c, _) in enumerate(cases)] + [(90, None), (91, b"\xff\xff\x81")]
    got = {r.i: r.f for r in spark.createDataFrame(rows, "i int, b binary").select("i", decoded(F.col("b")).alias("f")).collect()}
    assert [(got[i].text, got[i].charset) for i in range(len(cases))] == [(t, c) for t, _, c in cases]
    assert got[90] is None and got[91].text
