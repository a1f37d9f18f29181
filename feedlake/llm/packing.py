"""Packing documents into sequences by first-fit decreasing.

A document is its token ids and the end id. Whole multiples of ``size`` are
sequences of their own; what is left, the tail, is packed. Documents are dealt at
random into groups of about ``group``; in a group, tails go by decreasing length,
each into the first sequence with room for it. The sequences' room is kept in a
tournament tree: every inner place holds the larger room of the two below, so the
first sequence that fits is found on one way from the root.

Documents may be cut, so the group then closes its gaps: the emptiest sequences
are taken apart, their tails cut to the gaps of the fullest ones. One sequence a
group is left short; it is cut at powers of two, whose lengths are not padded.

The token ids travel once, to their group; a group's tails are what a task holds
(``group`` times less than ``size`` ids). Groups are dealt by a hash of the key and
the row's place, so rows that repeat one key spread over all groups.

Ids come from the rank file that holds the tokenizer's own vocabulary (equal for
every code point, see the tests); a special token spelled out in a text is one id,
as the tokenizers library has it unless told otherwise.

Defined results: null text is the empty text, so its document is the end id alone;
repeated rows are documents of their own; a null key is a key like any other; an
empty table gives no sequences. Texts of any length are cut for the tokenizer as in
``bpe``. Extra columns do not matter.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import bounded_batches

SIZE, GROUP, SEED = 1024, 2048, 29
END_ID = 0
#: Fixed value: the special token of the vocabulary and its id.
SPECIAL = {"<|endoftext|>": 50256}


class Rooms:
    """A tournament tree over the room of ``n`` sequences of ``size`` ids."""

    def __init__(self, n: int, size: int):
        self.width = 1 << max(0, n - 1).bit_length()
        self.most = [size] * (2 * self.width)

    def first_fit(self, need: int) -> int:
        """The first sequence with room for ``need``, which is taken from it."""
        most, at = self.most, 1
        while at < self.width:
            at *= 2
            if most[at] < need:
                at += 1
        slot, room = at - self.width, most[at] - need
        most[at] = room
        while at > 1:
            at >>= 1
            higher = max(most[2 * at], most[2 * at + 1])
            if most[at] == higher:
                break
            most[at] = higher
        return slot


def first_fit_decreasing(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Sequences of item numbers. No item is longer than ``size``."""
    rooms, bins = Rooms(len(lengths), size), []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        slot = rooms.first_fit(lengths[i])
        if slot == len(bins):
            bins.append([])
        bins[slot].append(i)
    return bins


def close_gaps(bins: list[list[int]], lengths: list[int], size: int = SIZE) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length): the emptiest ones are taken apart and
    fill the gaps of the others; the last one is cut at powers of two."""
    full = [[(i, 0, lengths[i]) for i in b] for b in bins]
    used = [sum(lengths[i] for i in b) for b in bins]
    open_ = sorted((b for b in range(len(full)) if used[b] < size), key=used.__getitem__)  # emptiest first
    low, high = 0, len(open_) - 1
    while low < high:
        to, of = open_[high], open_[low]
        gap = size - used[to]
        i, start, n = full[of].pop()
        take = min(gap, n)
        full[to].append((i, start + n - take, take))
        used[to] += take
        used[of] -= take
        if take < n:
            full[of].append((i, start, n - take))
        if used[to] == size:
            high -= 1
        if not full[of]:
            low += 1
    out = [b for b in full if b]
    if low == high and used[open_[low]] < size:
        rest = full[open_[low]]
        out.remove(rest)
        out += _at_powers(rest, used[open_[low]])
    return out


def _at_powers(rest: list[tuple[int, int, int]], used: int) -> list[list[tuple[int, int, int]]]:
    """One short sequence as sequences whose lengths are powers of two."""
    out, rest = [], rest[::-1]
    while used:
        room = 1 << (used.bit_length() - 1)
        used -= room
        out.append([])
        while room:
            i, start, n = rest.pop()
            take = min(room, n)
            out[-1].append((i, start, take))
            room -= take
            if take < n:
                rest.append((i, start + take, n - take))
    return out


def token_ids(enc, text: str, special: dict = SPECIAL) -> list[int]:
    """Ids of a whole text; special tokens spelled out in it are single ids."""
    for token, token_id in special.items():
        if token in text:
            parts = [token_ids(enc, part, {k: v for k, v in special.items() if k != token}) for part in text.split(token)]
            return [i for k, part in enumerate(parts) for i in ([token_id] if k else []) + part]
    return bpe.encode(enc, text)


def _parts(rows: DataFrame, rank_file: str, pattern: str, size: int, key_type: str) -> DataFrame:
    """``group, key, start, doc_tokens, ids`` (little-endian 16-bit, if that holds the
    vocabulary): the full sequences of every document, and its tail."""

    def run(batches):
        enc = bpe.encoding(rank_file, pattern)
        kind = np.uint16 if max(enc.max_token_value, *SPECIAL.values()) < 1 << 16 else np.uint32
        for batch in batches:
            of, start, tokens, parts, held = [], [], [], [], 0
            for r, t in enumerate(batch.column(2)):
                ids = np.array([*token_ids(enc, t.as_py() or ""), END_ID], kind)
                for s in range(0, len(ids), size):
                    of.append(r)
                    start.append(s)
                    tokens.append(len(ids))
                    parts.append(ids[s:s + size].tobytes())
                held += len(ids)
                if held > 1 << 20 or r == batch.num_rows - 1:
                    at = pa.array(of, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int64()),
                         pa.array(tokens, pa.int64()), pa.array(parts, pa.binary())],
                        names=["group", "key", "start", "doc_tokens", "ids"])
                    of, start, tokens, parts, held = [], [], [], [], 0

    return rows.mapInArrow(run, f"group long, key {key_type}, start long, doc_tokens long, ids binary")


def pack(docs: DataFrame, rank_file: str, pattern: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE,
         group: int = GROUP, seed: int = SEED) -> DataFrame:
    """A row for every piece: ``key, start, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset``. Sequence ids are unique, not gapless."""
    groups = max(1, -(-docs.count() // group))
    column = F.col(f"`{key}`")
    deal = F.pmod(F.xxhash64(F.lit(seed), column.cast("string"), F.monotonically_increasing_id()), F.lit(groups))
    rows = bounded_batches(docs).select(deal.alias("group"), column.alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    wide = 2 if _vocabulary_fits_16(rank_file, pattern) else 4

    def run(batches):
        now, count, tails = None, 0, []

        def close(at):
            """The sequences of a group's tails, as rows."""
            lengths = [len(t[3]) // wide for t in tails]
            made = close_gaps(first_fit_decreasing(lengths, size), lengths, size)
            out = []
            for s, sequence in enumerate(made):
                offset = 0
                for i, start, n in sequence:
                    k, begin, tokens, ids = tails[i]
                    out.append((k, begin + start, _as32(ids[wide * start:wide * (start + n)], wide), tokens,
                                (at << 32) + count + s, offset))
                    offset += n
            return out, len(made)

        def rows_out(out):
            cols = list(zip(*out)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([(key, batch.schema.field(1).type), ("start", pa.int64()), ("ids", pa.binary()),
                                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            out = []
            for g, k, start, tokens, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if g != now:
                    if tails:
                        out += close(now)[0]
                    now, count, tails = g, 0, []
                if len(ids) == size * wide:
                    out.append((k, start, _as32(ids, wide), tokens, (g << 32) + count, 0))
                    count += 1
                else:
                    tails.append((k, start, tokens, ids))
            if out:
                yield rows_out(out)
        if tails:
            yield rows_out(close(now)[0])

    return (_parts(rows, rank_file, pattern, size, key_type).repartition("group").sortWithinPartitions("group")
            .mapInArrow(run, f"`{key}` {key_type}, start long, ids binary, doc_tokens long, sequence_id long, offset long"))


def _vocabulary_fits_16(rank_file: str, pattern: str) -> bool:
    return max(bpe.encoding(rank_file, pattern).max_token_value, *SPECIAL.values()) < 1 << 16


def _as32(ids: bytes, wide: int) -> bytes:
    return ids if wide == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
