"""Text enrichment for action posts (NLP1-NLP9), in steps: digests, cuts, tags,
sentiment, stock pairs, article and news rows, rejects. Each step is a lazy
DataFrame over the tables it is given; only ``news`` writes something (the
digests, which its branches share)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import text as tx
from ..operators.dictionary import stock_pairs_join
from ..session import bound_batches, ensure_checkpoint_dir


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, temp_digest): NULL when no sentence can be scored; '' for an
    empty body. Texts go to Python in batches of bounded bytes."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", F.when(F.col("text") == "", F.lit("")).otherwise(tx.digest("text"))
                       .alias("temp_digest"))


def digests_once(docs: DataFrame) -> DataFrame:
    """``digests`` in a checkpoint, for results that read them in several branches, each of
    which would make them anew from the texts."""
    ensure_checkpoint_dir(docs.sparkSession)
    return digests(docs).checkpoint(eager=True)


def rejects(dg: DataFrame) -> DataFrame:
    """NLP9: a document whose digest failed is not written."""
    return dg.where(F.col("temp_digest").isNull()).select("doc_id", F.lit("no_digest").alias("reason"))


def cuts(dg: DataFrame) -> DataFrame:
    """NLP2: ``summary`` (digest cut 300), ``digest`` (text before the first tab)
    and ``short_digest`` (that cut 500)."""
    head = fn.before_first("temp_digest", "\t")
    return dg.where(F.col("temp_digest").isNotNull()).select(
        "doc_id", "temp_digest", fn.intercept("temp_digest", schemas.SUMMARY_CUT).alias("summary"),
        head.alias("digest"), fn.intercept(head, schemas.DIGEST_CUT).alias("short_digest"))


def tags(ok: DataFrame, dictionary: DataFrame) -> DataFrame:
    """NLP4 on the digests: doc_id, stock, industry, section."""
    words = tx.doc_tokens(ok.where(F.col("temp_digest") != ""), "doc_id", "temp_digest")
    return tx.dictionary_tags(words, dictionary, ok.select("doc_id"))


def sentiment_model(docs: DataFrame, labels: DataFrame):
    """Two-class model trained on labelled documents: quality 0 -> 'neg'."""
    lab = (labels.select("doc_id", F.when(F.col("quality") == 0, "neg").otherwise("pos").alias("label"))
           .join(docs.select("doc_id", "text"), "doc_id"))
    return tx.nb_train(tx.term_counts(lab, keep=("label",)), lab.select("doc_id", "label"))


def sentiment_by(ok: DataFrame, model: DataFrame, classes: DataFrame) -> DataFrame:
    """NLP6: (doc_id, sentiment): 'neg' -> 0, otherwise 1; empty digest -> -1; NULL
    where the model has no classes to choose from."""
    full = ok.where(F.col("temp_digest") != "")
    pred = tx.nb_predict(tx.term_counts(full, text_col="temp_digest"), model, classes, full.select("doc_id"))
    value = (F.when(F.col("temp_digest") == "", F.lit(-1))
             .when(F.col("predicted") == "neg", F.lit(0)).when(F.col("predicted").isNotNull(), F.lit(1)))
    return ok.join(pred, "doc_id", "left").select("doc_id", value.alias("sentiment"))


def sentiment(ok: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """NLP6 with a model trained here."""
    return sentiment_by(ok, *sentiment_model(docs, labels))


def stock_strings(tagged: DataFrame, dictionary: DataFrame) -> DataFrame:
    """NLP7: (doc_id, stock): name=code pairs, cut 500 (tail dropped only when cut)."""
    known = dictionary.where(F.col("facet") == "stock").select(F.col("term").alias("name"), "aliases")
    pairs = stock_pairs_join(tagged.where(F.col("stock") != ""), "doc_id", "stock", known, out="pairs")
    cut = tx.cut_before_last_if_truncated("pairs", schemas.DIGEST_CUT, "&")
    return (tagged.select("doc_id").join(pairs, "doc_id", "left")
            .select("doc_id", F.coalesce(cut, F.lit("")).alias("stock")))


def article_url(doc_id="doc_id"):
    return F.concat(F.lit(schemas.URLS[40004]["blog"]), F.col(doc_id).cast("string"))


def as_posts(docs: DataFrame) -> DataFrame:
    """Documents as action posts: doc_id, url, title, news_time, text."""
    return docs.select("doc_id", article_url().alias("url"), fn.before_first("text", "\n").alias("title"),
                       (F.lit(1460000000000) + F.col("doc_id") * 60000).alias("news_time"), "text")


def info_rows(ok: DataFrame, tagged: DataFrame, posts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The article_info row: the whole digest, its cut and the stock pairs."""
    return (ok.join(stock_strings(tagged, dictionary), "doc_id").join(posts.select("doc_id", "url"), "doc_id")
            .select("doc_id", "url", "digest", "summary", "stock"))


def news_rows(ok: DataFrame, tagged: DataFrame, senti: DataFrame, posts: DataFrame) -> DataFrame:
    """The news_info row: the cut digest, the tag names and the sentiment. Its clock
    column is added at the sink."""
    rows = ok.join(tagged, "doc_id").join(senti, "doc_id").join(posts.drop("text"), "doc_id")
    return rows.select(
        F.lit(2).alias("type"), F.lit(40004).alias("platform"), "title", "url", "news_time",
        "industry", "section", "stock", F.col("short_digest").alias("digest"), "summary", "sentiment",
        F.lit(schemas.PLATFORMS[3][1]).alias("source"), "doc_id")


def news(docs: DataFrame, labels: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """NLP8: -> (article_info rows, news_info rows)."""
    ok = cuts(digests_once(docs))
    tagged, posts = tags(ok, dictionary), as_posts(docs)
    return info_rows(ok, tagged, posts, dictionary), news_rows(ok, tagged, sentiment(ok, docs, labels), posts)
