"""Text enrichment behind the 40004 stream (NLP1-NLP9, SNK11).

Posts -> article rows not yet written -> digest and tags -> article_info -> news_info.
Each table is written from what was read back of the one before, so a post whose
article is not written has no digest row, and one whose digest failed has no news row;
posts that fail on the way are kept in a reject table with the reason.

The sentiment model and the keyword dictionary are saved under a version beforehand
(``save_models``); a micro-batch loads the newest complete version once and notes it
before it writes anything, so a replay uses the same one. A micro-batch reads, of all
that was written before, only the address buckets of its own posts.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sinks
from ..operators.keyed_tables import KeyedLog, list_names
from ..plans import enrich

POST = "doc_id bigint, url string, title string, news_time bigint, text string"
MODEL_PARTS = ("model", "dictionary", "classes")   # the last one written completes a version


def save_models(path: str, version: int, model: DataFrame, classes: DataFrame, dictionary: DataFrame) -> None:
    parts = dict(model=model, dictionary=dictionary, classes=classes)
    for name in MODEL_PARTS:
        parts[name].write.mode("overwrite").parquet(f"{path}/version={version}/{name}")


@dataclass
class Models:
    model: DataFrame
    dictionary: DataFrame
    classes: DataFrame


def newest_version(spark: SparkSession, path: str) -> int:
    """The newest version all of whose parts are written."""
    versions = sorted((int(n[8:]) for n in list_names(spark, path) if n.startswith("version=")), reverse=True)
    for v in versions:
        if "_SUCCESS" in list_names(spark, f"{path}/version={v}/{MODEL_PARTS[-1]}"):
            return v
    raise ValueError(f"no complete version of the models below {path}")


def load_models(spark: SparkSession, path: str, version: int) -> Models:
    return Models(*[spark.read.parquet(f"{path}/version={version}/{p}") for p in MODEL_PARTS])


def version_of_batch(spark: SparkSession, models_path: str, out_dir: str, batch_id: int) -> int:
    """The models' version a batch uses: noted by its first attempt."""
    note = f"{out_dir}/models_used/batch={batch_id}"
    if "_SUCCESS" not in list_names(spark, note):
        (spark.createDataFrame([(newest_version(spark, models_path),)], "version int").coalesce(1)
         .write.mode("overwrite").parquet(note))
    return spark.read.schema("version int").parquet(note).first()["version"]


def _write(df: DataFrame, out_dir: str, name: str, batch_id: int) -> DataFrame:
    path = f"{out_dir}/{name}/batch={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_batch(out_dir: str, models_path: str):
    """foreachBatch sink: three tables, each from the one before, in order."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        m = load_models(spark, models_path, version_of_batch(spark, models_path, out_dir, batch_id))
        log = KeyedLog(spark, f"{out_dir}/written", {"url": "string"})
        posts = batch.persist()
        old = log.state(batch_id, posts)
        articles = _write(sinks.insert_if_absent(posts, old, ["url"]), out_dir, "articles", batch_id)
        posts.unpersist()
        log.write(articles.select("url"), batch_id)
        dg = _write(enrich.digests(articles), out_dir, "digests", batch_id)
        ok = enrich.cuts(dg)
        tagged = _write(enrich.tags(ok, m.dictionary), out_dir, "tags", batch_id)
        senti = _write(enrich.sentiment_by(ok, m.model, m.classes), out_dir, "sentiment", batch_id)
        no_model = senti.where("sentiment is null").select("doc_id", F.lit("no_model").alias("reason"))
        _write(enrich.rejects(dg).unionByName(no_model), out_dir, "rejects", batch_id)
        sure = ok.join(senti.where("sentiment is not null").select("doc_id"), "doc_id", "left_semi")
        info = _write(enrich.info_rows(sure, tagged, articles, m.dictionary).where("stock is not null"), out_dir,
                      "article_info", batch_id)
        done = sure.join(info.select("doc_id"), "doc_id", "left_semi")
        _write(enrich.news_rows(done, tagged, senti, articles), out_dir, "news_info", batch_id)

    return sink


def start(posts: DataFrame, models_path: str, out_dir: str, checkpoint: str, available_now: bool = False):
    """A stream of ``POST`` rows through the three tables."""
    from .feed import _trigger
    w = (posts.writeStream.foreachBatch(write_batch(out_dir, models_path)).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    return _trigger(w, available_now).start()
