"""Language identification by a linear-chain CRF over words.

Every word of a text gets label probabilities by forward-backward (``crf``), so
code-switched text is labelled word by word. A document's language is the label
with the largest weighted sum of probabilities, its score that sum's share. All
words count; word i (from 0) weighs 1 / (1 + i / ``OPENING``), at least ``FLOOR``, because a label
names the language a text sets out in rather than the one it may switch to.

The model is learned from labelled documents: at most ``DOCS_PER_LANG`` rows of
each of the ``MOST_LANGS`` most frequent labels, picked by a hash of ``doc_id``,
one snippet of ``SNIPPET`` characters at a hashed place of each (the documented
bound of the training sample; predictions read whole texts). Documents carry one
label, so sequences that switch languages are made by joining pieces of several
snippets: that is what the transitions are learned from.

Defined results: null text, and text without a letter, give ``und`` with score
0; without any labelled row every text gives ``und``; rows with null ``doc_id``
count as held out; ties go to the label that sorts first; repeated rows each
give a row. Letter runs of over ``crf.LONGEST_WORD`` letters are read as several
words. ``lang``, ``source`` and ``doc_id`` are never inputs of a prediction.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches
from .crf import LONGEST_WORD, Model, posteriors, train

#: The training sample: rows of a label, rows of all (at least one of each label), characters of a row.
DOCS_PER_LANG, DOCS, SNIPPET = 300, 15_000, 600
FOLDS, UNKNOWN = 5, "und"
#: Labels whose counts are broadcast.
MOST_BROADCAST = 10_000
#: Word i weighs 1 / (1 + i / OPENING), at least FLOOR: all from 0.1 on do equally well on the training folds.
OPENING, FLOOR = 20, 0.25
_RUN = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")
#: Characters labelled together, and new words scored together.
_CHARS, _FRESH = 1 << 19, 4096
#: Entries of a task's word cache: memory (about 200 bytes each) for time.
CACHE = 100_000
#: Scores a task's cache holds at most, whatever the number of labels.
MOST_SCORES = 8_000_000


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the folds; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def snippets(docs: DataFrame) -> DataFrame:
    """``lang, snippet``: the bounded training sample, of each label the ``DOCS_PER_LANG``
    rows with the smallest hash; fewer of each, at least one, if all were more than ``DOCS``. A first cut by the hash, at four times the
    share that is needed, leaves the ranking about that many rows at any scale."""
    at = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.char_length("text") - SNIPPET, F.lit(1)).cast("long"))
    rows = (bounded_batches(docs).select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"),
                                         F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("h"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0)))
    labels = rows.select("lang").distinct().count()
    most = max(1, min(DOCS_PER_LANG, DOCS // max(1, labels)))
    count = rows.groupBy("lang").agg(F.count("*").alias("n"))
    count = F.broadcast(count) if labels <= MOST_BROADCAST else count
    share = F.col("h").cast("double") / 2.0**64 + 0.5
    order = Window.partitionBy("lang").orderBy("h", "snippet")
    return (rows.join(count, "lang").where(share < 4.0 * max(most, 8) / F.col("n"))
            .select("lang", "h", F.substring("text", at.cast("int") + 1, F.lit(SNIPPET)).alias("snippet"))
            .withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("lang", "snippet"))


def learn(docs: DataFrame, seed: int = 7) -> Model:
    """Train on the driver from the bounded sample."""
    sample = sorted((r["lang"], r["snippet"]) for r in snippets(docs).collect())
    labels = sorted({lang for lang, _ in sample})
    rng = np.random.default_rng(seed)
    pieces = []
    for lang, text in sample:
        words = [w for w in _RUN.findall(text.lower()) if any(map(str.isalpha, w))]
        words = words[1:-1] or words  # the cut may have split the outer words
        while words:
            n = int(rng.integers(4, 40))
            pieces.append((words[:n], [labels.index(lang)] * len(words[:n])))
            words = words[n:]
    rng.shuffle(pieces)
    sequences = []
    for i in range(0, len(pieces), 3):
        group = pieces[i:i + 3]
        sequences.append(([w for ws, _ in group for w in ws], [y for _, ys in group for y in ys]))
    return train(sequences, labels)


class Labeller:
    """Labels the words of texts, with a cache of emission scores by word."""

    def __init__(self, model: Model, cache: int = CACHE):
        self.model, self.cache = model, min(cache, MOST_SCORES // max(1, len(model.labels)))
        self.clear()

    def clear(self):
        self.slot: dict = {}
        self.used = 0
        self.table = np.zeros((1024, len(self.model.labels)))

    def forget(self, words: list[str]):
        """Keep the cached scores of ``words`` only (common words are among any)."""
        kept = {w: self.slot[w] for w in set(words) & self.slot.keys()}
        scored = {w: i for w, i in kept.items() if i >= 0}
        self.used = len(scored)
        self.table[:self.used] = self.table[list(scored.values())]
        self.slot = {**kept, **dict(zip(scored, range(self.used)))}

    def rows(self, words: list[str]) -> np.ndarray:
        """Places of the words' scores in ``table``; -1 for words without a letter."""
        if len(self.slot) > self.cache:
            self.forget(words)
        get = self.slot.get
        found = list(map(get, words))
        if None in found:
            fresh = list(dict.fromkeys(w for w, f in zip(words, found) if f is None))
            letters = [w for w in fresh if w.isalpha() or any(map(str.isalpha, w))]
            used, need = self.used, self.used + len(letters)
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]))
                grown[:used] = self.table[:used]
                self.table = grown
            for i in range(0, len(letters), _FRESH):
                part = letters[i:i + _FRESH]
                self.table[used + i:used + i + len(part)] = self.model.emissions(part)
            self.slot.update(dict.fromkeys(fresh, -1))
            self.slot.update(zip(letters, range(used, need)))
            self.used = need
            found = list(map(get, words))
        return np.array(found, np.int64)

    def shares(self, texts: list[str]) -> np.ndarray:
        """Weighted mean label probabilities of the words of each text; NaN without words."""
        words, sizes = [], []
        for t in texts:
            own = _RUN.findall(t.lower())
            words += own
            sizes.append(len(own))
        rows = self.rows(words)
        text = np.repeat(np.arange(len(texts)), sizes)[rows >= 0]
        rows = rows[rows >= 0]
        length = np.bincount(text, minlength=len(texts))
        out = np.full((len(texts), len(self.model.labels)), np.nan)
        some = np.flatnonzero(length)
        if len(some):
            p = posteriors(self.table[rows], length[some], self.model.moves)
            begin = np.cumsum(length[some]) - length[some]
            place = np.arange(len(p)) - np.repeat(begin, length[some])
            weight = np.maximum(FLOOR, 1 / (1 + place / OPENING))[:, None]
            out[some] = np.add.reduceat(p * weight, begin, axis=0) / np.add.reduceat(weight, begin, axis=0)
        return out


def label_column(text: Column, model: Model, cache: int = CACHE) -> Column:
    """Struct ``lang_pred, score`` of a text column."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model, cache)
        names = np.array([*model.labels, UNKNOWN], dtype=object)
        for batch in batches:
            best, score = np.full(len(batch), len(model.labels)), np.zeros(len(batch))
            texts, size = [], 0
            for end, t in enumerate(batch, 1):
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if (size > _CHARS or end == len(batch)) and model.labels:
                    share = labeller.shares(texts)
                    some, own = ~np.isnan(share[:, 0]), slice(end - len(texts), end)
                    best[own][some] = share[some].argmax(axis=1)
                    score[own][some] = np.minimum(share[some].max(axis=1), 1.0)
                    texts, size = [], 0
            yield pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                                             ["lang_pred", "score"])

    return label(text)


def predict(docs: DataFrame, model: Model, cache: int = CACHE) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; the text alone is read."""
    return (bounded_batches(docs).select("doc_id", label_column(F.col("text").cast("string"), model, cache).alias("p"))
            .select("doc_id", "p.lang_pred", "p.score"))


def identify(docs: DataFrame, cache: int = CACHE) -> DataFrame:
    """Learn from ``docs`` and predict them: ``doc_id, held_out, lang_pred, score``."""
    found = predict(docs, learn(docs), cache)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
                        "lang_pred", "score")
