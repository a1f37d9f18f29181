"""Corpus pipeline over ``documents``: language ID, near-dedup, substring dedup,
mixing to target weights, byte-level BPE.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents`` (and any others
the table has); the last returns ``doc_id, n_tokens, ids``.

Null, empty, repeated and clashing inputs have the results the operators define;
beyond those: the first stage drops what language ID rejects, texts without a letter,
also where no row is labelled and nothing can be learned; a text of which substring
dedup leaves nothing is dropped, one that it does not touch stays as it is, with its
white space; ``n_chars`` follows a changed text.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import bpe, langid, mixing, simhash, substring
from feedlake.llm.common import materialise, table
from feedlake.llm.queries import RANKS

#: Share of its input's tokens that the mixing stage keeps at least, in expectation.
LEAST_KEPT = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: all that hold a letter."""
    text, model = F.col("text").cast("string"), langid.learn(docs)
    if not model.labels:
        return docs.where(F.regexp_like(text, F.lit(r"\p{L}")))
    return docs.where(langid.label_column(text, model)["lang_pred"] != langid.UNKNOWN)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated 35-word windows."""
    found = substring.remove_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return found.select(*[(F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new
                           else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixing_sample(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample calibrated to the source, language and topic targets, of a size
    that one rare label cannot push below ``LEAST_KEPT``."""
    return mixing.sample(docs, least=LEAST_KEPT)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; decoding them gives the text back, else the stage fails."""
    import public_tokenizers
    return bpe.tokenize(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, result="ids")


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mixing_sample), ("byte_bpe", tokens)]

#: A trained language model, fingerprints and components are beyond SQL; the
#: tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name)
    return docs
