"""Exact substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one text. Words
covered by a window whose words also start anywhere else are removed.

1. The minimiser of a window is its smallest hash of ``MINIMISER`` consecutive
   words, leftmost on ties. Consecutive windows that share a minimiser's place
   are a super-k-mer. Equal windows have equal minimisers at equal offsets, so
   a window can repeat only inside its minimiser's bucket. A first pass ships
   no text, only (minimiser, digest of the text, start, length); a super-k-mer
   whose minimiser occurs once in the corpus holds no repeat and goes no further.
2. Equal texts collapse to one with a count, before their shuffle, so a group of
   exact copies travels once.
3. Every other super-k-mer travels to its bucket as one packed string; equal
   strings of a task travel once, with their number. In a bucket of more than
   ``SPLIT`` super-k-mers windows travel one by one to sub-buckets by their hash,
   so a common line splits over as many tasks as it has different windows.
4. A bucket sorts its windows and counts them exactly; each packed string gets
   the mask of its windows that occur more than once.
5. The masks go back to the texts and cover words.

Defined results: null text has no words; a text of fewer than ``WINDOW`` words
keeps all; repeated rows (also with equal ``doc_id``) count as occurrences, and
each gets its row; a window overlapping its own other occurrence counts as two.
Kept words are joined by one space. Texts are processed whole.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, packed, split_join

WINDOW, MINIMISER, SPLIT = 35, 8, 4000
#: Multiplier of the rolling combination of word hashes (odd, so no bits are lost).
_MIX = 0x9E3779B97F4A7C15
#: Entries of the word-hash cache of a task; it is emptied when full.
_CACHE = 100_000


def word_hashes(words: list[bytes], cache: dict) -> np.ndarray:
    from xxhash import xxh64_intdigest
    if len(cache) > _CACHE:
        cache.clear()
    get = cache.get
    out = [get(w) for w in words]
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                w = words[i]
                out[i] = cache[w] = xxh64_intdigest(w)
    return np.array(out, np.uint64)


def super_kmers(words: list[bytes], cache: dict, window: int = WINDOW, m: int = MINIMISER):
    """``minimiser, start, windows`` arrays of a text's super-k-mers."""
    h = word_hashes(words, cache)
    n = len(h) - m + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(m):
        mixed = mixed * np.uint64(_MIX) + h[j:j + n]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    view = np.lib.stride_tricks.sliding_window_view(mixed, window - m + 1)
    at = view.argmin(axis=1) + np.arange(len(view))
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return mixed[at[start]].view(np.int64), start, np.diff(np.r_[start, len(at)])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``tid, copies, text`` of the different texts."""
    return docs.groupBy("tid").agg(F.count("*").alias("copies"), F.first("text").alias("text"))


def _locate(docs: DataFrame, window: int, m: int) -> DataFrame:
    """``mini, tid, start, n`` of all super-k-mers of all rows; no text."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            found, of = [(np.zeros(0, np.int64),) * 3], [np.zeros(0, np.int64)]
            for i, t in enumerate(batch.column(1)):
                words = t.as_py().encode().split()
                if len(words) >= window:
                    found.append(super_kmers(words, cache, window, m))
                    of.append(np.full(len(found[-1][0]), i))
            mini, start, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mini), batch.column(0).take(pa.array(np.concatenate(of))),
                 pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], names=["mini", "tid", "start", "n"])

    return docs.select("tid", "text").mapInArrow(run, "mini long, tid binary, start int, n int")


_TRAVEL = pa.schema([("pid", pa.binary()), ("tid", pa.binary()), ("start", pa.int32()), ("n", pa.int32()),
                     ("mini", pa.int64()), ("sub", pa.int64()), ("packed", pa.binary()), ("c", pa.int64())])


def _packed_strings(located: DataFrame, texts: DataFrame, window: int, split: int) -> DataFrame:
    """The super-k-mers whose minimiser occurs more than once: a row ``pid, tid,
    start, n`` each (``pid`` is the 128-bit hash of the packed string). Of equal
    strings packed by a task one after the other, the first row also carries
    ``mini, sub, packed`` and their number ``c``; ``sub`` is 0 but in split buckets."""
    counts = located.groupBy("mini").agg(F.count("*").alias("c")).where("c > 1")
    asked = (split_join(located, counts, ["mini"])
             .select("tid", F.struct("mini", "start", "n", (F.col("c") > split).alias("hot")).alias("s"))
             .groupBy("tid").agg(F.collect_set("s").alias("s")))  # copies ask for the same

    def run(batches):
        from xxhash import xxh3_128_digest, xxh64_intdigest
        rows: list[list] = []
        first: dict = {}
        size = 0

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TRAVEL)], schema=_TRAVEL)
            rows.clear()
            first.clear()
            return out

        for batch in batches:
            for tid, copies, text, skmers in zip(*batch.columns):
                tid, copies, words = tid.as_py(), copies.as_py(), text.as_py().encode().split()
                for s in skmers.as_py():
                    mini, start, n, hot = s["mini"], s["start"], s["n"], s["hot"]
                    for a, k in ([(a, 1) for a in range(start, start + n)] if hot else [(start, n)]):
                        p = b" ".join(words[a:a + k + window - 1])
                        pid = xxh3_128_digest(p)
                        at = first.setdefault(pid, len(rows))
                        if at == len(rows):
                            rows.append([pid, tid, a, k, mini, xxh64_intdigest(p) >> 1 if hot else 0, p, copies])
                            size += len(p)
                        else:
                            rows[at][7] += copies
                            rows.append([pid, tid, a, k, None, None, None, None])
                            size += 64
                if size > 8 << 20:
                    yield flush()
                    size = 0
        if rows:
            yield flush()

    return (texts.select("tid", "copies", "text").join(asked, "tid").select("tid", "copies", "text", "s")
            .mapInArrow(run, "pid binary, tid binary, start int, n int, mini long, sub long, packed binary, c long"))


def _count_windows(strings: DataFrame, window: int) -> DataFrame:
    """``pid, repeated``: the mask (one byte a window) of each packed string that
    holds a window occurring more than once."""

    def bucket(rows):
        """Sort the windows of one bucket; equal neighbours are repeats."""
        strings: dict = {}
        for p, n, c, pid in rows:
            strings.setdefault(pid, [p, n, 0])[2] += c
        masks = {pid: bytearray(b"\1" * n if c > 1 else n) for pid, (_, n, c) in strings.items()}
        windows = []
        for pid, (p, n, _) in strings.items():
            if n == 1:
                windows.append((p, pid, 0))
            else:
                ends = np.flatnonzero(np.frombuffer(p + b" ", np.uint8) == 32)
                begins = np.r_[0, ends[:-1] + 1]
                windows += [(p[b:e], pid, i) for i, (b, e) in
                            enumerate(zip(begins[:n].tolist(), ends[window - 1:].tolist()))]
        if len(strings) > 1:
            windows.sort()
            for (w, r, i), (w2, r2, i2) in zip(windows, windows[1:]):
                if w == w2:
                    masks[r][i] = masks[r2][i2] = 1
        return [(pid, bytes(mask)) for pid, mask in masks.items() if 1 in mask]

    def run(batches):
        key, rows, out = None, [], []

        def flush():
            done = pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()),
                                               pa.array([o[1] for o in out], pa.binary())], names=["pid", "repeated"])
            out.clear()
            return done

        for batch in batches:
            for *k, packed_, n, c, pid in zip(*(col.to_pylist() for col in batch.columns)):
                if k != key:
                    if rows:
                        out += bucket(rows)
                    key, rows = k, []
                rows.append((packed_, n, c, pid))
            if len(out) > 50_000:
                yield flush()
        if rows:
            out += bucket(rows)
        yield flush()

    return (strings.select("mini", "sub", "packed", "n", "c", "pid").repartition("mini", "sub")
            .sortWithinPartitions("mini", "sub").mapInArrow(run, "pid binary, repeated binary"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, split: int = SPLIT) -> DataFrame:
    """``tid, spans``: (start, mask) of every super-k-mer with repeated windows."""
    rows = bounded_batches(docs).select(F.col("text").cast("string").alias("text")).where("text is not null").select(
        F.unhex(F.md5("text")).alias("tid"), "text")
    located = materialise(_locate(rows, window, m), "minimisers")
    travel = materialise(_packed_strings(located, distinct_texts(rows), window, split), "superkmers")
    masks = _count_windows(travel.where("packed is not null"), window)
    return (split_join(travel.select("pid", "tid", "start"), masks, ["pid"])
            .groupBy("tid").agg(F.collect_list(F.struct("start", "repeated")).alias("spans")))


def keep(words: list, spans, window: int = WINDOW) -> list:
    """The words no repeated window covers."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, mask in spans:
        at = start + np.flatnonzero(np.frombuffer(mask, np.uint8))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, m: int = MINIMISER, split: int = SPLIT) -> DataFrame:
    """``row, n_words, n_removed, kept`` for every row of ``docs``: ``row`` is the
    struct of its columns, ``kept`` its kept words joined by one space."""
    spans = repeated_spans(docs, window, m, split)

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        n, removed, kept = [], [], []
        for text, spans in zip(texts, found):
            words = (text.as_py() or "").encode().split()
            left = words if not spans.is_valid else keep(words, [(s["start"], s["repeated"]) for s in spans.as_py()], window)
            n.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                           pa.array(kept, pa.string())], ["n_words", "n_removed", "kept"])

    # Spark would copy a deterministic function below a caller's filter on its result and
    # run it twice, in twice as many Python workers
    once = cut.asNondeterministic()
    text = F.col("row.text").cast("string")
    rows = packed(docs, "row").withColumn("tid", F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    return (split_join(rows, spans, ["tid"], "left").select("row", once(text, F.col("spans")).alias("r"))
            .select("row", "r.n_words", "r.n_removed", "r.kept"))
