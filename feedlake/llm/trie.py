"""Prefix trie of conversations from sorted sequences, without a tree or a stack.

A turn is the 128-bit digest of (role, text); a conversation is the string of its
turns' digests. Conversations are sorted by that string (range partitions, ties by
``conv_id``, so a conversation that a third of the corpus shares is split too).
Then, block by block of the sorted rows:

* ``lcp[j]`` is the number of first turns that row j shares with row j - 1;
* a candidate prefix (j, d) is a prefix of row j that row j - 1 does not have;
* a sparse table over ``lcp`` answers range minima, and every candidate
  binary-searches by itself how far to the left and to the right the rows still
  share its d turns. That interval is its members; everything a node reports is
  then a difference of prefix sums or a range minimum over the interval, and its
  parent is the interval of d - 1 turns found in the same way.

A block knows how much its first row shares with the row before it, so intervals
that touch an edge of a block report exact parts: these few (prefixes of a block's
first or last row) are added up by node afterwards, everything else is final. The
member ids that end at a node are hashed as runs of decimal text in sorted order.

Defined results: turns are ordered by ``turn`` (null first), equal numbers by the
digest; null role or text is empty; repeated rows are turns of their own; rows
with null ``conv_id`` belong to no conversation and take no part; ``%`` keeps the
sign of its left side; an empty table has no nodes. Extra columns do not matter.
The digests of one conversation (20 bytes a turn) have to fit in a task.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import bounded_batches, materialise, split_join

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn's digest.
UNIT = 16
#: A block ends with the row that reaches one of these.
BLOCK_ROWS, BLOCK_TURNS = 1 << 16, 1 << 18
#: Conversations whose ids share ``conv_id - conv_id % FAMILY`` borrow from that one.
FAMILY, BORROW = 20, 4
NOTHING = hashlib.sha256(b"").hexdigest()


def conversations_of(turns: DataFrame, family: int = FAMILY, borrow: int = BORROW) -> DataFrame:
    """``conv_id, key, words``: rebuilt conversations of rows ``conv_id, turn, role,
    text``; ``key`` is the string of digests, ``words`` the words of each turn.

    A conversation c takes its first h turns from conversation ``c - c % family``
    (h = crc32 of the decimal c modulo ``borrow``) and goes on with its own."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.char_length(role), F.lit(":"), role, text), 256), 1, 2 * UNIT)
    cid = F.col("conv_id").cast("long")
    rows = turns.where("conv_id is not null").select(
        (cid - cid % family).alias("base"), cid.alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.unhex(digest).alias("d"),
                 F.regexp_count(text, F.lit(WORD)).alias("w")).alias("t"))
    # one exchange by family serves the grouping and the look at the family's base
    own = (rows.repartition("base").groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
           .select("base", "conv_id", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["w"].alias("w"))).alias("ts")))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("ts", 1, max(1, borrow - 1))))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrow
    h = h.cast("int")
    both = own.withColumn("head", head.over(Window.partitionBy("base"))).select(
        "conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("ts", 1, 0)),
                            F.slice("ts", h + 1, F.size("ts"))).alias("ts"))
    return both.select("conv_id", F.unhex(F.array_join(F.transform("ts", lambda t: F.hex(t["d"])), "")).alias("key"),
                       F.transform("ts", lambda t: t["w"]).alias("words"))


def common_turns(a: bytes, b: bytes) -> int:
    """The number of first turns two keys share."""
    m = min(len(a), len(b)) // UNIT
    same = np.frombuffer(a[:m * UNIT], "V16") == np.frombuffer(b[:m * UNIT], "V16")
    return m if same.all() else int(same.argmin())


def neighbour_lcp(keys: list[bytes], length: np.ndarray) -> np.ndarray:
    """``lcp[j]`` of rows j - 1 and j for j > 0; ``lcp[0]`` is left 0."""
    at = np.r_[0, np.cumsum(length)]
    units = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    shared = np.minimum(length[1:], length[:-1])
    out = np.zeros(len(keys), np.int64)
    some = np.flatnonzero(shared)
    if len(some):
        m = shared[some]
        begin = np.r_[0, np.cumsum(m)[:-1]]
        k = np.arange(m.sum()) - np.repeat(begin, m)
        left, right = np.repeat(at[some], m) + k, np.repeat(at[some + 1], m) + k
        differs = (units[left] != units[right]).any(axis=1)
        out[some + 1] = np.minimum.reduceat(np.where(differs, k, np.repeat(m, m)), begin)
    return out


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of 1, 2, 4, ... values from every place on."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        last, step = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-step], last[step:]))
    return table


def extent_right(table: list, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row that shares ``depth`` turns with ``row`` and all between."""
    at, n = row.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        ask = np.flatnonzero(at + (1 << k) < n)
        ask = ask[table[k][at[ask] + 1] >= depth[ask]]
        at[ask] += 1 << k
    return at


def extent_left(table: list, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row that shares ``depth`` turns with ``row`` and all between."""
    at = row.copy()
    for k in range(len(table) - 1, -1, -1):
        ask = np.flatnonzero(at - (1 << k) >= 0)
        ask = ask[table[k][at[ask] - (1 << k) + 1] >= depth[ask]]
        at[ask] -= 1 << k
    return at


def range_minimum(table: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    level = np.frexp(right - left + 1)[1] - 1
    out = np.empty(len(left), np.int64)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][left[at]], table[k][right[at] - (1 << k) + 1])
    return out


def prefix_names(key: bytes) -> list[bytes]:
    """A digest for each prefix of a key, the empty one included."""
    h = hashlib.sha256()
    out = [h.digest()[:UNIT]]
    for i in range(0, len(key), UNIT):
        h.update(key[i:i + UNIT])
        out.append(h.copy().digest()[:UNIT])
    return out


_PIECE = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                    ("p", pa.int32()), ("block", pa.int32()), ("ends", pa.string())])
_PIECE_DDL = ("node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, ends_sha256 string, p int, block int, ends string")


def block_nodes(keys: list[bytes], convs: np.ndarray, words: np.ndarray, before: tuple[int, int], p: int,
                block: int) -> pa.RecordBatch:
    """The nodes of one block of sorted rows. ``before`` is what the first row
    shares with the row before it (-1: there is none) and the turns of that row.
    A node whose interval touches an edge has a name, the others have none."""
    n = len(keys)
    length = np.array([len(k) // UNIT for k in keys], np.int64)
    at = np.r_[0, np.cumsum(length)]
    lcp = neighbour_lcp(keys, length)
    lcp0, before_length = before
    table = sparse_table(lcp)
    # candidates: prefixes that the row before does not have; all of the first row
    start = np.r_[0, lcp[1:] + 1]
    many = length - start + 1
    first = np.r_[0, np.cumsum(many)]
    j = np.repeat(np.arange(n), many)
    d = np.arange(first[-1]) - np.repeat(first[:-1] - start, many)
    left, right = extent_left(table, j, d), extent_right(table, j, d)
    size = right - left + 1
    begun = (j == 0) & (d <= lcp0)  # the node began in an earlier block
    smallest = range_minimum(sparse_table(convs), left, right)
    # parents: the interval of one turn less around the same row
    has = np.flatnonzero(d > 0)
    up = extent_left(table, j[has], d[has] - 1)
    parent = np.full(len(j), -1)
    parent[has] = first[up] + d[has] - 1 - start[up]
    children = np.bincount(parent[(parent >= 0) & ~begun], minlength=len(j))
    # a row that goes on from the whole row before it leaves no leaf there
    goes_on = np.r_[0, np.cumsum(np.r_[False, lcp[1:] == length[:-1]])]
    leaves = size - (goes_on[right + 1] - goes_on[left + 1]) - (begun & (lcp0 == before_length))
    # words of all members below, less the words of every node once
    sums = np.r_[0, np.cumsum(words)]
    upto = lambda row, k: sums[at[row] + k] - sums[at[row]]
    whole = upto(np.arange(n), length)
    fresh = np.r_[0, whole[1:] - upto(np.arange(1, n), lcp[1:])]
    wholes, freshes = np.r_[0, np.cumsum(whole)], np.r_[0, np.cumsum(fresh)]
    above = upto(left, np.maximum(d - 1, 0))
    own_first = whole[left] - np.where(begun, upto(left, np.where(begun, max(lcp0, 0), 0)), above)
    saved = (wholes[right + 1] - wholes[left] - size * above) - (freshes[right + 1] - freshes[left + 1] + own_first)
    # ids that end at a node: the run of equal rows it starts with
    same = np.r_[False, (lcp[1:] == length[1:]) & (length[1:] == length[:-1])]
    run_end = np.append(np.flatnonzero(~same)[1:], n)
    run_of = np.cumsum(~same) - 1
    edge = (left == 0) | (right == n - 1)
    ids = [str(c) for c in convs.tolist()]
    digest, ends = [NOTHING] * len(j), [None] * len(j)
    for i in np.flatnonzero(d == length[j]).tolist():
        row = int(j[i])
        text = ",".join(ids[row:run_end[run_of[row]]])
        if edge[i]:
            ends[i] = text
        else:
            digest[i] = hashlib.sha256(text.encode()).hexdigest()
    of_first, of_last = prefix_names(keys[0]), prefix_names(keys[-1])
    name: list = [None] * len(j)
    for i in np.flatnonzero(edge).tolist():
        name[i] = of_first[d[i]] if left[i] == 0 else of_last[d[i]]
    parent_name = [name[i] if i >= 0 else None for i in parent.tolist()]
    known = (parent >= 0) & ~edge[parent]
    col = lambda x, drop=None: pa.array(x, pa.int64(), mask=drop)
    return pa.RecordBatch.from_arrays([
        pa.array(name, pa.binary()), pa.array(parent_name, pa.binary()), col(d), col(smallest),
        col(smallest[parent], ~known), col(size), col(children), col(leaves), col(saved),
        pa.array(digest, pa.string(), mask=edge), pa.array(np.full(len(j), p, np.int32)),
        pa.array(np.full(len(j), block, np.int32)), pa.array(ends, pa.string())], schema=_PIECE)


def _edges(rows: DataFrame) -> DataFrame:
    """``p, first, last``: the first and the last key of every partition with rows."""

    def run(batches):
        first = last = p = None
        for batch in batches:
            if batch.num_rows:
                p = batch.column(0)[0].as_py()
                first = batch.column(1)[0].as_py() if first is None else first
                last = batch.column(1)[batch.num_rows - 1].as_py()
        if p is not None:
            yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int32()), "first": pa.array([first], pa.binary()),
                                              "last": pa.array([last], pa.binary())})

    return rows.select("p", "key").mapInArrow(run, "p int, first binary, last binary")


def _before(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """What the first row of each partition shares with the last one before it.
    The driver gets two numbers a partition."""
    edges = materialise(_edges(rows), "trie-edges")
    parts = sorted(r["p"] for r in edges.select("p").collect())
    pairs = rows.sparkSession.createDataFrame(list(zip(parts[1:], parts)), "p int, prev int")

    def run(batches):
        for batch in batches:
            p, a, b = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_pydict({
                "p": pa.array(p, pa.int32()), "lcp": pa.array([common_turns(x, y) for x, y in zip(a, b)], pa.int64()),
                "turns": pa.array([len(x) // UNIT for x in a], pa.int64())})

    joined = (pairs.join(edges.select("p", "first"), "p")
              .join(edges.select(F.col("p").alias("prev"), "last"), "prev").select("p", "last", "first"))
    return {r["p"]: (r["lcp"], r["turns"]) for r in joined.mapInArrow(run, "p int, lcp long, turns long").collect()}


def _pieces(rows: DataFrame, before: dict, most_rows: int, most_turns: int) -> DataFrame:

    def run(batches):
        keys, convs, words, turns, block, ahead, p = [], [], [], 0, 0, None, 0

        def flush():
            return block_nodes(keys, np.array(convs, np.int64), np.concatenate(words).astype(np.int64), ahead, p, block)

        for batch in batches:
            w = batch.column(3)
            for i, (key, conv) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if ahead is None:
                    p = batch.column(0)[0].as_py()
                    ahead = before.get(p, (-1, 0))
                elif keys and (len(keys) >= most_rows or turns >= most_turns):
                    yield flush()
                    ahead = (common_turns(keys[-1], key), len(keys[-1]) // UNIT)
                    keys, convs, words, turns, block = [], [], [], 0, block + 1
                keys.append(key)
                convs.append(conv)
                words.append(w[i].values.to_numpy(zero_copy_only=False))
                turns += len(key) // UNIT
        if keys:
            yield flush()

    return rows.select("p", "key", "conv_id", "words").mapInArrow(run, _PIECE_DDL)


def _hash_of_runs(pieces: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the runs of ids of a node, hashed one after the other."""

    def run(batches):
        node, h = None, None
        for batch in batches:
            names, digests = [], []
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at == node:
                    h.update(b"," + text.encode())
                    continue
                if node is not None:
                    names.append(node)
                    digests.append(h.hexdigest())
                node, h = at, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(names, pa.binary()), "ends_sha256": pa.array(digests, pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()),
                                              "ends_sha256": pa.array([h.hexdigest()], pa.string())})

    return (pieces.where("ends is not null").select("node", "ends", "p", "block").repartition("node")
            .sortWithinPartitions("node", "p", "block").select("node", "ends")
            .mapInArrow(run, "node binary, ends_sha256 string"))


def nodes(conversations: DataFrame, *, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie's nodes from ``conv_id, key, words``: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    ensure_checkpoint_dir(conversations.sparkSession)
    # a checkpoint keeps the partitions and their order, so both passes see the same
    rows = (bounded_batches(conversations).select("key", "conv_id", "words").repartitionByRange("key", "conv_id")
            .sortWithinPartitions("key", "conv_id").checkpoint().withColumn("p", F.spark_partition_id()))
    pieces = materialise(_pieces(rows, _before(rows), block_rows, block_turns), "trie-pieces")
    edge = pieces.where("node is not null")
    total = edge.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    total = materialise(total.join(_hash_of_runs(edge), "node", "left")
                        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))), "trie-edges")
    names = total.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = pieces.where("node is null")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    asks = (inner.where("parent is not null").drop("parent_conv_id")
            .select("parent", *[c for c in out if c != "parent_conv_id"])
            .unionByName(total.where("parent is not null").drop("node")))
    return (inner.where("parent is null").select(out)
            .unionByName(split_join(asks, names, ["parent"]).select(out))
            .unionByName(total.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(out)))


def oracle(family: int = FAMILY, borrow: int = BORROW) -> str:
    """DuckDB SQL for the nodes of ``conversations``, by grouping whole prefixes."""
    crc = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, CAST(length(CAST(conv_id AS VARCHAR)) AS BIGINT) + 1),
      lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))), lambda c, b:
      list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
      CAST(4294967295 AS BIGINT))"""
    return f"""
WITH t AS (
  SELECT conv_id, turn, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'d': d, 'w': w}} ORDER BY turn NULLS FIRST, d) AS ts FROM t GROUP BY conv_id),
h AS (SELECT own.*, {crc} % {borrow} AS h FROM own),
re AS (
  SELECT h.conv_id, list_concat(coalesce(b.ts, [])[1:h.h], h.ts[h.h + 1:]) AS ts
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % {family}),
s AS (
  SELECT conv_id, len(ts) AS n, array_to_string(list_transform(ts, lambda x: x.d), '') AS k,
    list_transform(ts, lambda x: x.w) AS ws FROM re),
m AS (SELECT conv_id, n, d, substr(k, 1, 64 * d) AS node, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w
  FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM s)),
g AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, max(w) AS w,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (m.n = d), '') AS ends
  FROM m GROUP BY node, d),
k AS (SELECT substr(node, 1, 64 * (d - 1)) AS node, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
f AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN k USING (node)),
up AS (
  SELECT substr(node, 1, 64 * a) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((n - 1) * w) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children,
  CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN up USING (node) LEFT JOIN g q ON f.d > 0 AND q.node = substr(f.node, 1, 64 * (f.d - 1))"""
