"""Text enrichment (NLP1-NLP9) as Spark jobs.

The reference calls an external segmenter, summary service and model jar
per row. Here every step is a DataFrame job over exploded tokens:

  tokens      split on non letter/digit runs, lower-cased (NLP3)
  stop words  the corpus' k most frequent tokens (bounded k -> broadcast)
  tags        token x dictionary join, per-facet sorted sets (NLP4)
  naive Bayes counts per (class, token) as the model; scoring joins document
              tokens with one row of class weights a token (NLP5, NLP6)
  digest      sentence scores from document term counts, top-k per
              document, rejoined in text order (NLP1)

Counting inside one document (term counts, digest) is a small Arrow helper over
the rows as they are scanned, so no token occurrence is shuffled for it.
Nothing is collected to the driver; all groups are per document (bounded by
one text) or per token / class (combined map-side before the shuffle).
"""
from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, once, scratch_path
from .joins import splittable_join

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
#: Scripts written without spaces between words: their runs are read as character bigrams.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
SENTENCE = r"[^.!?\n]+[.!?]?"
_TOKEN, _SENTENCE = regex.compile(r"[\p{L}\p{N}]+"), re.compile(SENTENCE)
#: Texts without characters from here on have no unspaced runs, and the letters and digits
#: of ``re``, which is faster, are those of ``_TOKEN`` in them.
_BEYOND, _WORD = re.compile("[\u0530-\U0010ffff]"), re.compile(r"[^\W_]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]+")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def token_array(text) -> Column:
    """NLP3: lower-case, split on non letter/digit runs, drop ''. A run of characters
    of an unspaced script gives its bigrams (a single one itself)."""
    low = F.lower(_c(text))
    words = lambda t: F.filter(F.split(t, TOKEN_SPLIT), lambda x: x != "")

    def bigrams(t: Column) -> Column:
        n = F.length(t)
        many = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(2)))
        return F.when(F.regexp_like(t, F.lit("^" + UNSPACED)) & (n > 1), many).otherwise(F.array(t))

    apart = F.regexp_replace(low, f"({UNSPACED}+)", " $1 ")
    return F.when(F.regexp_like(low, F.lit(UNSPACED)), F.flatten(F.transform(words(apart), bigrams))).otherwise(words(low))


def tokens_of(text: str) -> list[str]:
    """``token_array`` of one text."""
    low = text.lower()
    if not _BEYOND.search(low):
        return _WORD.findall(low)
    if not _UNSPACED.search(low):
        return _TOKEN.findall(low)
    out = []
    for t in _TOKEN.findall(_UNSPACED.sub(lambda m: f" {m[0]} ", low)):
        out += [t[i:i + 2] for i in range(len(t) - 1)] if len(t) > 1 and _UNSPACED.match(t) else [t]
    return out


#: What a code point is, found out when it first comes up: 1 no, 2 a token character of an unspaced script.
_KIND = np.zeros(0x110000, np.int8)


def counts_of(text: str) -> Counter:
    """How often each of ``tokens_of(text)`` occurs. Bigrams are counted as pairs of
    neighbouring code points, without a string for every occurrence."""
    low = text.lower()
    if not _BEYOND.search(low):
        return Counter(_WORD.findall(low))
    if not _UNSPACED.search(low):
        return Counter(_TOKEN.findall(low))
    found = Counter(_TOKEN.findall(_UNSPACED.sub(" ", low)))
    points = np.frombuffer(low.encode("utf-32-le"), np.uint32)
    fresh = np.unique(points[_KIND[points] == 0])
    if len(fresh):
        _KIND[fresh] = [2 if _UNSPACED.match(c) and _TOKEN.match(c) else 1 for c in map(chr, fresh.tolist())]
    own = _KIND[points] == 2
    pair = own[:-1] & own[1:]
    keys, n = np.unique((points[:-1].astype(np.int64) << 21 | points[1:])[pair], return_counts=True)
    found.update({chr(k >> 21) + chr(k & 0x1FFFFF): c for k, c in zip(keys.tolist(), n.tolist())})
    found.update(map(chr, points[own & ~np.r_[False, pair] & ~np.r_[pair, False]].tolist()))
    return found


def doc_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (document, token occurrence)."""
    return docs.select(id_col, F.explode(token_array(text_col)).alias("token"))


def stop_words(tokens: DataFrame, k: int = 50) -> DataFrame:
    """The corpus' ``k`` most frequent tokens (ties by token). Bounded by
    ``k``, so it is safe to broadcast."""
    return (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("token")).limit(k).select("token"))


def remove_stop_words(tokens: DataFrame, stops: DataFrame) -> DataFrame:
    return tokens.join(F.broadcast(stops), "token", "left_anti")


def token_counts(text) -> Column:
    """Array of (token, tf) of one text. Counting inside a row has no built-in
    expression; as an Arrow UDF it needs no shuffle of token occurrences."""
    return once(F.arrow_udf(_token_counts, "array<struct<token: string, tf: bigint>>"))(_c(text))


def _token_counts(texts: pa.Array) -> pa.Array:
    found = [counts_of(t.as_py() or "") for t in texts]
    ends = np.cumsum([0, *map(len, found)])
    rows = pa.StructArray.from_arrays(
        [pa.array([t for c in found for t in c], pa.string()), pa.array([n for c in found for n in c.values()], pa.int64())],
        ["token", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a table scan, dealt out anew where they lie in fewer splits than there are
    cores, or one split has over twice its share of a core; others stay as they are. A row
    group is read by one task, so a file in one row group is one task, however many
    splits it has. The count reads no columns."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    held = scan.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    splits, most, rows = held.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    if not splits or splits >= cores and most * cores <= 2 * rows:
        return scan
    return scan.repartition(cores * math.ceil(scan.rdd.getNumPartitions() / cores))   # whole rounds of tasks


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """(doc, kept columns, token, tf) in one pass over the documents. Texts go to Python
    in batches of bounded bytes."""
    bound_batches(docs.sparkSession)
    return docs.select(id_col, *keep, F.inline(token_counts(text_col)))


def token_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(token, n, n_docs): occurrences of each token and how many different documents have
    it. Occurrences are counted inside their row, so that one row a (document, token)
    leaves the scan."""
    return (term_counts(docs, id_col, text_col).groupBy("token")
            .agg(F.sum("tf").alias("n"), F.countDistinct(id_col).alias("n_docs")))


# ---------------------------------------------------------------- dictionary tags
FACETS = ["stock", "industry", "section"]


def dictionary_tags(tokens: DataFrame, dictionary: DataFrame, docs: DataFrame,
                    id_col: str = "doc_id") -> DataFrame:
    """NLP4: for each document and facet, the sorted set of dictionary terms
    it mentions, comma-joined ('' when none). ``dictionary(term, facet)``."""
    hits = splittable_join(tokens, dictionary.select(F.col("term").alias("token"), "facet"), ["token"])
    agg = hits.groupBy(id_col).agg(*[
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("facet") == f, F.col("token")))), ",")
        .alias(f) for f in FACETS])
    return docs.select(id_col).join(agg, id_col, "left").select(
        id_col, *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in FACETS])


#: Bytes of phrases that every task may hold as an automaton; a larger dictionary is joined.
MOST_PHRASE_BYTES = 32 << 20


def phrase_hits(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                most_bytes: int = MOST_PHRASE_BYTES) -> DataFrame:
    """NLP4 for terms of any number of words: ``doc, term`` (each pair once) where the
    term's tokens follow each other in the text. A dictionary of up to ``most_bytes``
    becomes one keyword automaton a task, which reads each text once; of a larger one
    the texts' token runs of the terms' lengths are joined with the terms."""
    spark = docs.sparkSession
    bound_batches(spark)
    terms = (dictionary.select("term", token_array("term").alias("ts")).where(F.size("ts") > 0)
             .select("term", F.array_join("ts", " ").alias("key"), F.size("ts").alias("n")))
    lengths, size = terms.agg(F.array_sort(F.collect_set("n")), F.sum(F.octet_length("key") + F.octet_length("term"))).first()
    if not size:
        return docs.select(id_col, F.lit(None).cast("string").alias("term")).where("false")
    if size <= most_bytes:
        by_key: dict = {}
        for r in terms.collect():   # its size has just been checked
            by_key.setdefault(r["key"], []).append(r["term"])
        shared = spark.sparkContext.broadcast(by_key)
        find = F.arrow_udf(lambda texts: _find_phrases(texts, shared.value), "array<string>")
        return docs.select(id_col, F.explode(find(_c(text_col))).alias("term"))

    def runs_of(n: int) -> Column:
        """All runs of n tokens, joined by a space."""
        starts = F.sequence(F.lit(1), F.size("ts") - (n - 1))
        return F.when(F.size("ts") >= n, F.transform(starts, lambda i: F.array_join(F.slice("ts", i, n), " ")))

    runs = [runs_of(n) for n in lengths]
    grams = docs.select(id_col, token_array(text_col).alias("ts")).select(
        id_col, F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*runs))))).alias("key"))
    return splittable_join(grams, terms.select("key", "term"), ["key"]).select(id_col, "term").distinct()


def _find_phrases(texts: pa.Array, by_key: dict) -> pa.Array:
    import ahocorasick
    automaton = _AUTOMATA.get(id(by_key))
    if automaton is None:   # once a worker and dictionary
        automaton = ahocorasick.Automaton()
        for key, terms in by_key.items():
            automaton.add_word(f" {key} ", terms)
        automaton.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[id(by_key)] = automaton
    found = []
    for t in texts:
        words = " " + " ".join(tokens_of(t.as_py() or "")) + " "
        found.append(sorted({term for _, terms in automaton.iter(words) for term in terms}))
    return pa.array(found, pa.list_(pa.string()))


_AUTOMATA: dict = {}


def phrase_tags(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``dictionary_tags`` for terms of several words."""
    hits = splittable_join(phrase_hits(docs, dictionary, id_col, text_col, **kw), dictionary.select("term", "facet"), ["term"])
    agg = hits.groupBy(id_col).agg(*[
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("facet") == f, F.col("term")))), ",").alias(f) for f in FACETS])
    return docs.select(id_col).join(agg, id_col, "left").select(
        id_col, *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in FACETS])


# ---------------------------------------------------------------- naive Bayes
def nb_train(tf: DataFrame, labels: DataFrame, label_col: str = "label",
             id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """NLP5 training (multinomial, Laplace smoothing) from term counts
    ``tf(doc, label, token, tf)`` and ``labels(doc, label)`` (one row per
    document, those without tokens included).

    Returns ``(model, classes)``:
      model(label, token, n, log_p)      observed pairs only (sparse)
      classes(label, n_docs, n_tokens, log_prior, log_norm, vocab)
    with ``log_p = ln((n + 1) / (n_tokens + V))`` and
    ``log_norm = ln(n_tokens + V)``; an unseen in-vocabulary token scores
    ``-log_norm``. Only (label, token) sums are shuffled, combined map-side.
    """
    lab = labels.select(id_col, label_col)
    pairs = tf.groupBy(label_col, "token").agg(F.sum("tf").alias("n"))
    # the model's counts are written once, as columns: vocabulary size, class
    # totals and the model are read from them, the texts are not counted again
    path = scratch_path(tf.sparkSession, "nb")
    pairs.write.parquet(path)
    pairs = tf.sparkSession.read.schema(pairs.schema).parquet(path)
    v_size = pairs.select("token").distinct().agg(F.count(F.lit(1))).scalar()
    n_docs_all = lab.agg(F.count(F.lit(1))).scalar()
    per_class = pairs.groupBy(label_col).agg(F.sum("n").alias("n_tokens"))
    docs_per_class = lab.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_docs"))
    classes = (docs_per_class.join(per_class, label_col, "left")
               .select(label_col, "n_docs", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
                       F.ln(F.col("n_docs") / n_docs_all).alias("log_prior"),
                       F.ln(F.coalesce("n_tokens", F.lit(0)) + v_size).alias("log_norm"),
                       v_size.alias("vocab")))
    model = (pairs.join(classes.select(label_col, "log_norm"), label_col)
             .select(label_col, "token", "n",
                     (F.ln(F.col("n") + 1) - F.col("log_norm")).alias("log_p")))
    return model, classes


#: Bytes of token weights that every task may hold: those of the most frequent tokens; rarer ones are joined by a shuffle.
MOST_WEIGHT_BYTES = 64 << 20
MOST_CLASSES = 512


def nb_predict(tf: DataFrame, model: DataFrame, classes: DataFrame, docs: DataFrame,
               label_col: str = "label", id_col: str = "doc_id") -> DataFrame:
    """NLP5 scoring: ``score(d, c) = log_prior(c) - T_d * log_norm(c) +
    sum_t tf * ln(n_ct + 1)`` where ``T_d`` counts the document's
    in-vocabulary tokens.

    The model becomes one row a token with an array of its class weights, written so
    that its size is known. The most frequent tokens' weights, up to ``MOST_WEIGHT_BYTES``,
    are broadcast, and their counts, which are nearly all, are summed where they lie; only
    counts of rarer tokens, one by one, and one row a document are shuffled, into a join
    AQE can split. One aggregate sums all classes of a document, combined map-side. The
    classes (at most ``MOST_CLASSES``; name and two numbers each) are literals of the plan. Every
    document gets a score (documents without a known token score by prior; without
    classes there is none: NULL). Ties -> smallest label."""
    spark = docs.sparkSession
    rows = classes.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("c"), "log_prior", "log_norm") \
        .limit(MOST_CLASSES + 1).collect()
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    if not rows:
        return docs.select(id_col, F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("double").alias("score"))
    rows.sort(key=lambda r: r["c"])
    by_class = F.map_from_entries(F.collect_list(F.struct(F.col(label_col).cast("string"), F.ln(F.col("n") + 1))))
    each = F.transform(F.array(*[F.lit(r["c"]) for r in rows]), lambda c: F.coalesce(F.try_element_at(F.col("m"), c), F.lit(0.0)))
    level = F.floor(F.log2(F.greatest("n", F.lit(1))) * 4).cast("int").alias("level")   # of how often the token occurs; at most 256
    w = (model.where(F.col(label_col).isNotNull()).groupBy("token").agg(by_class.alias("m"), F.sum("n").alias("n"))
         .select("token", each.alias("ws"), level))
    path = scratch_path(spark, "nb-weights")
    w.write.parquet(path)
    w = spark.read.schema(w.schema).parquet(path)
    room, least = MOST_WEIGHT_BYTES // (8 * len(rows) + 48), None   # the lowest level whose tokens all find room
    for r in sorted(w.groupBy("level").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        room -= r["k"]
        if room < 0:
            break
        least = r["level"]
    weighed = [F.sum(F.col("tf") * F.col("ws")[i]).alias(f"s{i}") for i in range(len(rows))]
    if room >= 0:
        sums = tf.join(F.broadcast(w), "token").groupBy(id_col).agg(F.sum("tf").alias("t"), *weighed)
    else:
        common = F.lit(False) if least is None else F.col("level") >= least
        sums = _sums_by_parts(tf, w.where(common), w.where(~common), weighed, id_col)
    t = F.coalesce("t", F.lit(0))
    scored = F.array(*[F.struct((-(F.lit(r["log_prior"]) - t * F.lit(r["log_norm"]) + F.coalesce(f"s{i}", F.lit(0.0)))).alias("ns"),
                                F.lit(r["c"]).alias("c")) for i, r in enumerate(rows)])
    best = F.array_min(scored)
    return (docs.select(id_col).join(sums, id_col, "left")
            .select(id_col, best["c"].alias("predicted"), (-best["ns"]).alias("score")))


def _sums_by_parts(tf: DataFrame, common: DataFrame, rare: DataFrame, weighed: list[Column], id_col: str) -> DataFrame:
    """``doc, t, s0, ..``: in-vocabulary tokens and weighted sums of each document. Counts
    of ``common`` tokens become one row a document before anything is shuffled; each of the
    others stays a row, which the shuffle takes to its weights in ``rare``."""
    rest = F.col("ws").isNull()
    names = [f"s{i}" for i in range(len(weighed))]
    known = (tf.join(F.broadcast(common.select("token", "ws")), "token", "left")
             .select(id_col, F.when(rest, F.col("token")).alias("token"), "tf", "ws")
             .groupBy(id_col, "token").agg(F.sum("tf").alias("tf"), *weighed))
    # a document's own row has no token and is dealt by the document
    at = known.withColumn("_pk", F.when(F.col("token").isNull(), F.xxhash64(id_col)).otherwise(F.xxhash64("token")))
    far = rare.select("token", F.xxhash64("token").alias("_pk"), "ws").hint("merge")   # its size in the file says little
    own = F.col("token").isNull()
    met = at.join(far, ["token", "_pk"], "left").select(id_col, F.when(own | F.col("ws").isNotNull(), F.col("tf")).alias("t"), *[
        F.when(own, F.col(s)).otherwise(F.col("tf") * F.col("ws")[i]).alias(s) for i, s in enumerate(names)])
    return met.groupBy(id_col).agg(F.sum("t").alias("t"), *[F.sum(s).alias(s) for s in names])


# ---------------------------------------------------------------- digest
def digest_of(text: str, k: int) -> str | None:
    """NLP1 re-aimed, for one text: score each sentence by the mean in-document
    count of its tokens (rounded to 6 places, halves up), keep the top ``k`` (ties
    by position), joined in text order by ' '. None when no sentence has a token."""
    sentences = _SENTENCE.findall(text)
    words = [tokens_of(s) for s in sentences]
    count = Counter(chain.from_iterable(words)).__getitem__
    scored = [(-math.floor(sum(map(count, ts)) / len(ts) * 1e6 + 0.5), i) for i, ts in enumerate(words) if ts]
    best = sorted(i for _, i in heapq.nsmallest(k, scored))
    return " ".join(sentences[i].strip(" ") for i in best) if best else None


def digest(text, k: int = 3) -> Column:
    """Digest column of a text column: one pass over each row, no shuffle. NULL
    (the reference's failure value) for a text without a scorable sentence."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([digest_of(t.as_py() or "", k) for t in texts], pa.string())

    return once(run)(_c(text))


def cut_before_last_if_truncated(s, n: int, sep: str) -> Column:
    """NLP7 (Q4 decided): cut to ``n``; only when that truncated, drop the
    partial tail after the last ``sep``."""
    s = _c(s)
    cut = F.substring(s, 1, n)
    tail = F.substring_index(cut, sep, -1)
    before = F.substring(cut, F.lit(1), F.length(cut) - F.length(tail) - F.lit(len(sep)))
    return F.when(F.length(s) > n, F.when(F.instr(cut, sep) > 0, before).otherwise(cut)).otherwise(s)
