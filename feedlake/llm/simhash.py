"""SimHash near-duplicates: fingerprints, BK-tree search in shards, components.

* Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles are
  ``width`` consecutive words joined by a space, repeats included (fewer words:
  the whole sequence; none: fingerprint zero). A bit of the fingerprint is 1 if
  it is set in over half of the shingles' XXH64 (seed 42).
* Equal fingerprints collapse before any search, so copies cost nothing there.
* Shards by the pigeonhole: the 64 bits are cut into ``radius + 2`` blocks. Two
  fingerprints that differ in at most ``radius`` bits agree on two blocks at
  least, so for every pair of blocks the fingerprints with equal bits there
  form a shard. One unsharded BK-tree would make each search visit a fixed
  share of all fingerprints; shards keep trees small and lose no link.
* Each shard is a BK-tree (``bktree``), searched within the radius by all its
  members. A shard of more than ``tree_size`` members is cut into trees of that
  size, and every tree is sent to the queries of every block of the shard, pair
  by pair, over as many tasks. Nothing is capped.
* Of the links found only a spanning forest per tree pair leaves the task;
  ``components.stars`` joins them.

Defined results: null text is a text without words; all texts without words
share fingerprint zero and are linked; repeated rows stay; rows with null
``doc_id`` count, but the smallest id ignores them (null if a component has no
other). Texts of any length are processed whole, in chunks of shingles.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bktree import Forest, spanning
from .common import bounded_batches, materialise, packed, split_join
from .components import stars

WIDTH, RADIUS, SEED = 4, 4, 42
TREE_SIZE = 4096
_CHUNK = 255 * 256

#: For each byte value eight lanes of one byte with its bits, lowest first.
_LANES = np.ascontiguousarray(np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view(np.uint64).ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the uint64 hashes have each of the 64 bits set."""
    n = -len(hashes) % 255
    lanes = _LANES[np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8)].reshape(-1, 8)
    if n:
        lanes = np.concatenate([lanes, np.zeros((n, 8), np.uint64)])
    # up to 255 ones fit into a lane
    sums = np.ascontiguousarray(lanes.reshape(-1, 255, 8).sum(axis=1))
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes, width: int = WIDTH) -> int:
    """Unsigned SimHash of UTF-8 text. ``bytes.lower`` changes A-Z only and
    ``bytes.split`` cuts at exactly the six white-space bytes."""
    from xxhash import xxh64_intdigest
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(text, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:len(words) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    total, counts = len(starts), np.zeros(64, np.int64)
    for i in range(0, total, _CHUNK):
        part = [xxh64_intdigest(text[s:e], SEED) for s, e in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])]
        counts += bit_counts(np.array(part, np.uint64))
    return int(np.packbits((2 * counts > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, width: int = WIDTH) -> Column:
    """SimHash of a text column as a (signed) long."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = [fingerprint((t.as_py() or "").encode(), width) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return simhash(text)


def shard_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks of all pairs of the ``radius + 2`` blocks, as signed longs."""
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


def _runs(batches, names: list[str], keys: int, most: int | None = None):
    """Batches of rows sorted by their first ``keys`` columns, as numpy, cut only
    between keys; a key of over ``2 * most`` rows is passed on in parts of a
    multiple of ``most`` rows, so that no key is ever held whole."""
    held = None
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        n = len(cols[0])
        if not n:
            continue
        other = np.flatnonzero(np.any([c != c[-1] for c in cols[:keys]], axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield [c[:cut] for c in cols]
        if most and n - cut > 2 * most:
            begin, cut = cut, cut + (n - cut - 1) // most * most
            yield [c[begin:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield held


def near_links(values: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp`` long), enough
    of them to connect whatever is connected at ``radius`` or fewer bits."""
    masks = shard_masks(radius)
    shards = (values.select("fp", F.posexplode(F.array([F.col("fp").bitwiseAND(F.lit(m)) for m in masks])))
              .select(F.col("pos").alias("k"), F.col("col").alias("v"), "fp")
              .repartition("k", "v").sortWithinPartitions("k", "v", "fp"))
    schema = pa.schema([("k", pa.int32()), ("v", pa.int64()), ("block", pa.int64()), ("a", pa.int64()),
                        ("b", pa.int64())])

    def first_pass(batches):
        """Links of all shards that are one tree; members of larger shards by
        block (``b`` null), in the order they stream by."""
        seen = [None, 0]

        def blocks(k, v, fp):
            """Parts of a large shard; ``seen`` counts over batches."""
            if seen[0] != (k, v):
                seen[:] = [(k, v), 0]
            number = (seen[1] + np.arange(len(fp))) // tree_size
            seen[1] += len(fp)
            return pa.record_batch([pa.array(np.full(len(fp), k, np.int32)), pa.array(np.full(len(fp), v, np.int64)),
                                    pa.array(number), pa.array(fp), pa.nulls(len(fp), pa.int64())], schema=schema)

        for k, v, fp in _runs(batches, ["k", "v", "fp"], 2, tree_size):
            run = np.cumsum(np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]) - 1
            size = np.bincount(run)
            begin = np.cumsum(size) - size
            large = size > tree_size
            large[0] |= seen[0] == (k[0], v[0])  # the rest of a shard passed on in parts
            for r in np.flatnonzero(large):
                s = slice(begin[r], begin[r] + size[r])
                yield blocks(int(k[s][0]), int(v[s][0]), fp[s])
            keep = (size[run] > 1) & ~large[run]
            if keep.any():
                values_, tree = fp[keep].view(np.uint64), run[keep]
                forest = Forest(values_, tree)
                a, b = spanning(len(values_), forest.search(values_, forest.root, forest.size, radius))
                if len(a):
                    own = fp[keep]
                    yield pa.record_batch([pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64()),
                                           pa.nulls(len(a), pa.int64()), pa.array(own[a]), pa.array(own[b])],
                                          schema=schema)

    first = materialise(shards.mapInArrow(first_pass, "k int, v long, block long, a long, b long"), "simhash")
    links = first.where("b is not null").select("a", "b")
    large = first.where("b is null").select("k", "v", "block", F.col("a").alias("fp"))
    top = large.groupBy("k", "v").agg(F.max("block").alias("top"))
    met = (split_join(large, top, ["k", "v"])
           .select("k", "v", "fp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("top"))).alias("other"))
           .select("k", "v", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")
           .repartition("k", "v", "i", "j").sortWithinPartitions("k", "v", "i", "j", "block", "fp"))

    def second_pass(batches):
        """One tree (block i) and the queries sent to it (block j) at a time."""
        for k, v, i, j, block, fp in _runs(batches, ["k", "v", "i", "j", "block", "fp"], 4):
            run = np.cumsum(np.r_[True, np.any([c[1:] != c[:-1] for c in (k, v, i, j)], axis=0)]) - 1
            for r in range(run[-1] + 1):
                s = np.flatnonzero(run == r)
                own = fp[s]
                nodes = np.flatnonzero(block[s] == i[s[0]])
                forest = Forest(own[nodes].view(np.uint64), np.zeros(len(nodes), np.int64))
                asks = np.arange(len(own)) if i[s[0]] == j[s[0]] else np.flatnonzero(block[s] != i[s[0]])
                found = forest.search(own[asks].view(np.uint64), np.zeros(len(asks), np.int64),
                                      np.full(len(asks), len(nodes)), radius)
                a, b = spanning(len(own), ((asks[q], nodes[n]) for q, n in found))
                yield pa.record_batch([pa.array(own[a]), pa.array(own[b])], names=["a", "b"])

    return links.unionByName(met.mapInArrow(second_pass, "a long, b long"))


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """``doc_id, fp, component_id, root`` for every row (``root`` is a fingerprint
    that names the component); see the module's text."""
    prints = materialise(bounded_batches(docs).select("doc_id", fingerprint_column(F.col("text").cast("string"), width).alias("fp")),
                         "fingerprints")
    by_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("m"))
    star = stars(near_links(by_fp.select("fp"), radius, tree_size))
    rooted = (by_fp.join(star.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "m", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("m").alias("component_id"))
    named = split_join(rooted.select("fp", "root"), least, ["root"])
    return split_join(prints, named, ["fp"]).select("doc_id", "fp", "component_id", "root")


def first_of_each(docs: DataFrame, *, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest
    ``doc_id`` (of rows sharing it, one with the smallest fingerprint)."""
    found = materialise(near_duplicates(docs, width=width, radius=radius), "near-duplicates")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    row = packed(docs, "row")
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        # written before it is joined, so the planner knows its size
        gone = materialise(found.where(~first).select(F.col("doc_id").alias("id")), "duplicates")
        return row.join(gone, F.col("row.doc_id").eqNullSafe(F.col("id")), "left_anti").select("row.*")
    # ids repeat: rows are told apart by id and fingerprint
    kept = found.where(first).groupBy("doc_id", "root").agg(F.min("fp").alias("least"))
    asked = row.withColumn("fp", fingerprint_column(F.col("row.text").cast("string"), width))
    return (asked.join(kept, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("fp") == F.col("least")),
                       "left_semi").withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "fp"]).select("row.*"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
