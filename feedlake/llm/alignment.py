"""Alignment of two tokenisations of the same bytes by merge paths.

Tokenizer A (byte-level ranks, special strings are plain text) encodes a space and
the text, tokenizer B (a sentencepiece model, which puts the space itself) the text;
both then cover the same bytes. Merging the two sorted lists of token ends gives all
overlaps: a merged end closes a stretch that lies in exactly one A and one B token.

The merge of a stretch of documents is cut by diagonals into pieces of ``WORK``
merged ends: a binary search on each diagonal finds how many ends of A and B lie
before it, so every piece is merged by itself and all are equal work. A piece
emits its overlaps; an end that A and B share and the groups that cross an edge are
settled where pieces meet. All pieces of a stretch are the rows of one matrix.

Counts of id pairs over the corpus, and then the documents' own sums, go by blocks
of documents (about ``BLOCK_BYTES`` of text): a block's dictionary holds each of its
pairs once, so a pair travels once a block, however common it is; a document holds
places in its block's dictionary and how often. The dictionaries come back from the
corpus-wide counts to the block's documents.

Long texts are cut where no token of A or B can cross (a single space between two
other characters: no match of A's pattern and no piece of B has a space after
something else); the ids are those of the whole text.

Defined results: a null or empty text, or one whose joined A or B bytes differ from
space and text, has no tokens (zeros, groups ''); repeated rows are documents of
their own and all count; an empty table gives no rows. Extra columns do not matter.
"""
from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe
from .common import bounded_batches, materialise, split_join

WORK = 1024
#: Characters of a segment, text bytes merged at once, and of a block.
SEGMENT, STRETCH, BLOCK_BYTES = 1 << 16, 1 << 20, 1 << 24
#: Entries at which a block's dictionary ends the block.
BLOCK_PAIRS = 1 << 20
SPACE = "▁"


@functools.lru_cache(maxsize=2)
def tokenizers(rank_file: str, pattern: str, piece_file: str):
    """A, B and the bytes of each of their tokens."""
    import sentencepiece
    a = bpe.encoding(rank_file, pattern)
    b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
    of_a = [a.decode_single_token_bytes(i) for i in range(a.max_token_value + 1)]
    of_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        of_b.append(bytes.fromhex(byte[1]) if byte else piece.replace(SPACE, " ").encode())
    return a, b, of_a, of_b, np.array([len(x) for x in of_a]), np.array([len(x) for x in of_b])


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """``text`` with a space before it, cut at safe places; each part starts with a space."""
    return list(bpe.pieces(" " + text, size))


def encode(tok, text: str, size: int = SEGMENT) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """A's and B's ids of each segment; None if the joined bytes of one differ."""
    a, b, of_a, of_b, _, _ = tok
    out = []
    for part in segments(text, size):
        ids_a, ids_b, raw = a.encode_ordinary(part), b.encode(part[1:]), part.encode()
        if b"".join(map(of_a.__getitem__, ids_a)) != raw or b"".join(map(of_b.__getitem__, ids_b)) != raw:
            return None
        out.append((np.array(ids_a, np.int64), np.array(ids_b, np.int64)))
    return out


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of sorted ``a`` and ``b`` (equal values: ``a`` first) crosses
    every ``work``-th diagonal: the numbers of values of a and of b before it."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        ask = np.flatnonzero(low < high)
        if not len(ask):
            return low, d - low
        mid = (low[ask] + high[ask]) >> 1
        before = a[mid] <= b[d[ask] - 1 - mid]
        low[ask[before]] = mid[before] + 1
        high[ask[~before]] = mid[~before]


def merge(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """The merged ends of ``a`` and ``b`` as ``from_b, i, j, shared``: whether an end
    is b's, how many ends of a and b lie before it, and whether it repeats a's."""
    i0, j0 = merge_path(a, b, work)
    n_a, n_b = np.diff(i0)[:, None], np.diff(j0)[:, None]
    place = np.arange(work)[None, :]
    # one row a piece: its ends of a, its ends of b, and nothing beyond
    keys = np.full((len(n_a), work), np.iinfo(np.int64).max)
    keys[place < n_a] = 2 * a
    keys[(place >= n_a) & (place < n_a + n_b)] = 2 * b + 1
    keys.sort(axis=1, kind="stable")  # two sorted runs a row
    from_b = (keys & 1).astype(bool)
    j = j0[:-1, None] + np.cumsum(from_b, axis=1) - from_b
    inside = place < n_a + n_b
    i = (i0[:-1, None] + place) - (j - j0[:-1, None])
    keys, from_b, i, j = keys[inside], from_b[inside], i[inside], j[inside]
    # pieces meet here: an end of b may repeat the last end of the piece before
    shared = from_b & (np.r_[-1, keys[:-1]] == keys - 1)
    return from_b, i, j, shared


_DIGITS = np.zeros((0, 0), np.uint8)


def digits(most: int) -> np.ndarray:
    """Decimal digits of 0..most, zero bytes before the first."""
    global _DIGITS
    if len(_DIGITS) <= most:
        wide = len(str(most))
        _DIGITS = np.array([str(i).rjust(wide, "\0").encode() for i in range(most + 1)], f"S{wide}").view(np.uint8).reshape(-1, wide)
    return _DIGITS


def align(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, work: int = WORK):
    """Links and groups of a stretch: ``i, j`` (token numbers of every link), the
    group of every token of A and of B, and the groups written as
    ``a1,a2|b1;a3|b2,b3;`` in bytes with, for each group, the byte its text ends at."""
    from_b, i, j, shared = merge(ends_a, ends_b, work)
    group = np.cumsum(shared) - shared
    of_a, of_b = group[~from_b], group[from_b]
    n = int(shared.sum())
    to_a, to_b = np.cumsum(np.bincount(of_a, minlength=n)), np.cumsum(np.bincount(of_b, minlength=n))
    begin_b = np.r_[0, to_b[:-1]]
    at_a, at_b = np.arange(len(ids_a)) + begin_b[of_a], np.arange(len(ids_b)) + to_a[of_b]
    token, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    token[at_a], token[at_b] = ids_a, ids_b
    last_a, last_b = to_a + begin_b - 1, to_a + to_b - 1
    mark[last_a], mark[last_b] = ord("|"), ord(";")
    table = digits(int(token.max(initial=0)))
    text = np.concatenate([table[token], mark[:, None]], axis=1)
    written = text != 0
    ends = np.cumsum(written.sum(axis=1))[last_b]
    return i[~shared], j[~shared], of_a, of_b, text[written].tobytes(), ends


class Document:
    """What is known of one document while its segments are aligned."""

    def __init__(self, keep_groups: bool):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.hash, self.sep = hashlib.sha256(), b""
        self.text: list | None = [] if keep_groups else None
        self.places: list = []
        self.times: list = []

    def add(self, part: bytes):
        """Groups of one segment, without the last separator."""
        self.hash.update(self.sep + part)
        if self.text is not None:
            self.text += [self.sep, part]
        self.sep = b";"

    def pairs(self) -> tuple[bytes, bytes]:
        """Places in the block's dictionary and how often, in the fewest bytes."""
        if not self.places:
            return b"", b""
        at, times = np.concatenate(self.places), np.concatenate(self.times)
        if len(self.places) > 1:
            at, back = np.unique(at, return_inverse=True)
            times = np.bincount(back, weights=times).astype(np.int64)
        return pack(at), pack(times)


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in the narrowest width; the first byte tells it."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64) if raw else np.zeros(0, np.int64)


#: A pair of ids as one number.
SHIFT = 32


def _aligned(rows: DataFrame, key: str, files: tuple, keep_groups: bool, work: int, block_bytes: int) -> DataFrame:
    """Two kinds of rows: documents (``pairs`` not null) and entries of the blocks'
    dictionaries (``code`` not null)."""

    def run(batches):
        from pyspark import TaskContext
        tok = tokenizers(*files)
        len_a, len_b = tok[4], tok[5]
        block0, n_block, held, codes, counts = TaskContext.get().partitionId() << 32, 0, 0, {}, []
        schema = None

        def stretch(todo):
            """Align (document, ids of a segment) one after the other as one merge."""
            ids_a = np.concatenate([t[1] for t in todo])
            ids_b = np.concatenate([t[2] for t in todo])
            na, nb = np.array([len(t[1]) for t in todo]), np.array([len(t[2]) for t in todo])
            i, j, of_a, _, text, ends = align(ids_a, ids_b, np.cumsum(len_a[ids_a]), np.cumsum(len_b[ids_b]), work)
            segment_of = np.repeat(np.arange(len(todo)), na)[i]
            code = (ids_a[i] << SHIFT) | ids_b[j]
            pairs, of_pair = np.unique(code, return_inverse=True)
            place = np.array([codes.setdefault(c, len(codes)) for c in pairs.tolist()], np.int64)
            counts.extend([0] * (len(codes) - len(counts)))
            for p, c in zip(place.tolist(), np.bincount(of_pair).tolist()):
                counts[p] += c
            both, times = np.unique((segment_of << SHIFT) | place[of_pair], return_counts=True)
            cut = np.searchsorted(both >> SHIFT, np.arange(len(todo) + 1))
            links = np.bincount(segment_of, minlength=len(todo))
            last_group = of_a[np.cumsum(na) - 1]
            begin, groups = 0, np.diff(np.r_[-1, last_group])
            for k, (doc, _, _) in enumerate(todo):
                doc.n_a += int(na[k])
                doc.n_b += int(nb[k])
                doc.n_links += int(links[k])
                doc.n_groups += int(groups[k])
                end = int(ends[last_group[k]])
                doc.add(text[begin:end - 1])
                begin = end
                doc.places.append(both[cut[k]:cut[k + 1]] & ((1 << SHIFT) - 1))
                doc.times.append(times[cut[k]:cut[k + 1]])

        def batch_of(**cols):
            n = len(next(iter(cols.values())))
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type)
                                               for f in schema], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([("block", pa.int64()), ("key", batch.schema.field(0).type), ("n_a", pa.int64()),
                                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                                    ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
                                    ("code", pa.int64()), ("place", pa.int64()), ("c", pa.int64())])
            keys, texts, r = batch.column(0), batch.column(1), 0
            while r < batch.num_rows:
                # rows up to about a stretch of text, all in one block
                docs, todo, size, first = [], [], 0, r
                while r < batch.num_rows and (r == first or size < STRETCH):
                    text = texts[r].as_py() or ""
                    doc = Document(keep_groups)
                    found = encode(tok, text) if text else None
                    for a, b in found or []:
                        todo.append((doc, a, b))
                    size += len(text)
                    docs.append(doc)
                    r += 1
                part, chars = [], 0
                for t in todo:  # a long text is merged in several stretches
                    part.append(t)
                    chars += 3 * len(t[1])
                    if chars > STRETCH:
                        stretch(part)
                        part, chars = [], 0
                if part:
                    stretch(part)
                made = [d.pairs() for d in docs]
                empty = lambda d: not d.n_a
                yield batch_of(block=[block0 + n_block] * len(docs), key=keys.slice(first, r - first),
                               n_a=[d.n_a for d in docs], n_b=[d.n_b for d in docs], n_groups=[d.n_groups for d in docs],
                               n_links=[d.n_links for d in docs],
                               groups=["" if empty(d) else b"".join(d.text).decode() if keep_groups else d.hash.hexdigest()
                                       for d in docs],
                               pairs=[m[0] for m in made], times=[m[1] for m in made])
                held += size
                if held >= block_bytes or len(codes) >= BLOCK_PAIRS:
                    yield batch_of(block=[block0 + n_block] * len(codes), code=list(codes), place=list(range(len(codes))), c=counts)
                    n_block, held, codes, counts = n_block + 1, 0, {}, []
        if codes:
            yield batch_of(block=[block0 + n_block] * len(codes), code=list(codes), place=list(range(len(codes))), c=counts)

    return rows.mapInArrow(run, f"block long, key {rows.schema['key'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
                                "n_links long, groups string, pairs binary, times binary, code long, place long, c long")


def pair_counts(entries: DataFrame) -> DataFrame:
    """``code, n, best``: links of each id pair over the corpus, and whether no other
    pair of its B id has more."""
    total = entries.groupBy("code").agg(F.sum("c").alias("n"))
    b = F.col("code").bitwiseAND(F.lit((1 << SHIFT) - 1))
    # a B id meets at most the vocabulary of A
    return total.withColumn("b", b).withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b"))).drop("b")


def align_documents(docs: DataFrame, rank_file: str, pattern: str, piece_file: str, *, key: str = "doc_id",
                    text: str = "text", result: str = "groups", work: int = WORK,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for every row of ``docs``: ``key, n_a, n_b, n_groups, n_links, n_best,
    count_sum`` and ``groups``, or with ``result='digests'`` its ``groups_sha256``."""
    name = {"groups": "groups", "digests": "groups_sha256"}[result]
    rows = bounded_batches(docs).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    made = materialise(_aligned(rows, key, (rank_file, pattern, piece_file), result == "groups", work, block_bytes), "alignment")
    entries = made.where("code is not null").select("block", "code", "place", "c")
    back = split_join(entries.drop("c"), pair_counts(entries), ["code"]).select(
        F.col("block").alias("of"), "place", "n", "best")
    columns = ["key", "n_a", "n_b", "n_groups", "n_links", "groups"]
    found = made.where("code is null").select("block", *columns, "pairs", "times")
    key_type = rows.schema["key"].dataType.simpleString()

    def sums(group, documents: pa.Table, dictionary: pa.Table) -> pa.Table:
        n, best = np.zeros(dictionary.num_rows, np.int64), np.zeros(dictionary.num_rows, np.int64)
        at = dictionary.column("place").to_numpy()
        n[at] = dictionary.column("n").to_numpy()
        best[at] = dictionary.column("best").to_numpy()
        n_best, count_sum = [], []
        for p, t in zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist()):
            p, t = unpack(p), unpack(t)
            n_best.append(int(t @ best[p]))
            count_sum.append(int(t @ n[p]))
        return (documents.select(columns).append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(count_sum, pa.int64())))

    out = found.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(
        sums, f"key {key_type}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")
    return out.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("groups").alias(name))
