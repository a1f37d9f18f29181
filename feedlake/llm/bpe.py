"""Byte-level BPE encoding and decoding of whole texts.

Ranks come from a tiktoken rank file (``base64 rank`` per line) that lies on
every executor; the file is read once per Python worker. Merging is done by
the tiktoken library. Very long texts are cut first, at places no match of the
split pattern can cross, so that one call never sees more than about
``PIECE`` characters: memory stays bounded and the ids equal those of the whole
text. Decoding joins the raw bytes of the ids; text is never decoded in parts.

Defined results: null text is the empty text (no tokens, digest of nothing); a
text without any safe cut (one endless word) is encoded in one call; repeated
rows each give a row; extra columns of the input do not matter.
"""
from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

PIECE = 1 << 16
#: A space between two characters that are no white space. Every match of the
#: pattern that holds a space starts with it or is white space only, so a match
#: never runs across this place.
SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str):
    import tiktoken
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut only where no match
    of the split pattern can cross."""
    at = 0
    while len(text) - at > size:
        cut = SAFE_CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(enc, text: str) -> list[int]:
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    return [i for part in pieces(text) for i in enc.encode_ordinary(part)]


def decode(enc, ids: list[int]) -> bytes:
    """The bytes of the ids, joined before anything reads them as text."""
    return enc.decode_bytes(ids)


#: Columns beside key and ``n_tokens``, by kind of result.
RESULTS = {"full": "ids array<int>, decoded binary", "ids": "ids array<int>",
           "digests": "ids_sha256 string, decoded_sha256 string"}


def tokenize(docs: DataFrame, rank_file: str, pattern: str, *, key: str = "doc_id", text: str = "text",
             result: str = "full") -> DataFrame:
    """A row for every row of ``docs``: ``key, n_tokens`` and, by ``result``,

    * ``full``: ``ids`` and ``decoded`` (the bytes the ids decode to);
    * ``ids``: ``ids`` alone, after a check that they decode to the text;
    * ``digests``: ``ids_sha256`` (of decimal ids joined by commas) and
      ``decoded_sha256``.
    """

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            n, left, right = [], [], []
            for t in batch.column(1):
                t = t.as_py() or ""
                ids = encode(enc, t)
                raw = decode(enc, ids)
                n.append(len(ids))
                if result == "digests":
                    left.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    right.append(hashlib.sha256(raw).hexdigest())
                    continue
                left.append(np.array(ids, np.int32))
                if result == "full":
                    right.append(raw)
                elif raw != t.encode():
                    raise ValueError("the ids do not decode to the text")
            names = [c.split()[0] for c in RESULTS[result].split(", ")]
            cols = [pa.array(left, pa.string() if result == "digests" else pa.list_(pa.int32()))]
            if len(names) > 1:
                cols.append(pa.array(right, pa.string() if result == "digests" else pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *cols],
                                             names=[key, "n_tokens", *names])

    d = bounded_batches(docs).select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(run, f"`{key}` {d.schema[key].dataType.simpleString()}, n_tokens long, {RESULTS[result]}")
