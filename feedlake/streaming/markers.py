"""Keyed marker state (INC1-INC5 in streaming form).

One group = one page: a platform and an address, as in the page store (two platforms
may hold pages under one address, whose markers are of different kinds). Snapshots of
a page are taken in the order of ``msg_seq`` and each is paired with the marker left
by the one before. The state holds, per
page, the number of the last snapshot taken and the marker it left; a snapshot that
arrives late, behind one that was already taken, moves no marker and yields no items
(what it shows is older than what was emitted). A page's state lives for ``ttl`` after
its last snapshot, so pages that are no longer crawled do not stay for ever; the
table of written addresses keeps such a page from writing its articles again when it
comes back.

Markers from before the stream are its initial state, read once in the first
micro-batch; one that names no platform counts for its address on each of them. The state is kept in RocksDB with changes as its checkpoints.

The Python step sees one row per snapshot; the item array rides along as one
JSON string that it never opens. Which items are new is decided afterwards by
the same expressions as in the batch form (``platform_items.unseen``).
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import PLATFORMS

#: A number that grows with arrival (see ``sources.tables.message_stream``).
SEQ = T.DecimalType(38, 0)
SNAPSHOT = T.StructType([
    T.StructField("msg_seq", SEQ),
    T.StructField("platform_id", T.IntegerType()),
    T.StructField("marker_kind", T.StringType()),
    T.StructField("needs_login", T.IntegerType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("newest", T.StringType()),
    T.StructField("payload", T.StringType()),
])
OUT_SCHEMA = T.StructType([*SNAPSHOT.fields[:5], SNAPSHOT["payload"], T.StructField("last_key", T.StringType())])
STATE_SCHEMA = T.StructType([T.StructField("seq", T.StringType()), T.StructField("last_key", T.StringType())])
#: How long a page that is not seen keeps its marker.
TTL_DAYS = 90
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession):
    """Settings a query with this state is started under (it keeps those of its start):
    the store that a time to live needs, and no batches without data, which a state
    with processing time would otherwise ask for without end. State that has expired is
    not returned by the store, and is removed with the next batch."""
    want = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_long(text: str | None) -> int | None:
    """``try_cast`` of a text as bigint."""
    if text is None or not re.fullmatch(r"\s*[+-]?[0-9]+\s*", text) or not -2**63 <= int(text) < 2**63:
        return None
    return int(text)


def next_marker(kind: str, last: str | None, new: str | None) -> str | None:
    """``platform_items.next_marker`` for one value."""
    if kind != "ts":
        return last if new is None else new
    times = [t for t in (as_long(last), as_long(new)) if t is not None]
    return str(max(times)) if times else None


def walk(rows, seq: int | None, last: str | None):
    """Snapshots (``msg_seq, marker_kind, newest``) in order, each with the marker
    before it, without late ones; and the state they leave."""
    taken = []
    for r in sorted(rows, key=lambda r: r["msg_seq"]):
        if seq is not None and int(r["msg_seq"]) <= seq:
            continue
        seq = int(r["msg_seq"])
        taken.append((r, last))
        last = next_marker(r["marker_kind"], last, r["newest"])
    return taken, seq, last


class Markers(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("marker", STATE_SCHEMA, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((None, initialState["last_key"]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seq, last = self.state.get() if self.state.exists() else (None, None)
        taken, seq, last = walk(rows, None if seq is None else int(seq), last)
        if taken:
            self.state.update((str(seq), last))
        for r, before in taken:
            yield Row(**{c: before if c == "last_key" else r[c] for c in OUT_SCHEMA.names})


def with_markers(pages: DataFrame, seeds: DataFrame, ttl_ms: int) -> DataFrame:
    """A stream of snapshots -> the same rows with the marker before each. ``seeds``:
    ``page_url, last_key`` and, where known, ``platform_id``."""
    page, named = ["platform_id", "page_url"], F.array(F.col("platform_id").cast("int"))
    each = F.array(*[F.lit(p[0]) for p in PLATFORMS])
    of = F.when(F.col("platform_id").isNull(), each).otherwise(named) if "platform_id" in seeds.columns else each
    known = seeds.where("page_url is not null and last_key is not null").select(F.explode(of).alias("platform_id"), "page_url", "last_key")
    initial = known.groupBy(*page).agg(F.max("last_key").alias("last_key"))   # one a page, whatever the order
    return pages.groupBy(*page).transformWithState(
        Markers(ttl_ms), OUT_SCHEMA, "append", "processingTime", initial.groupBy(*page))
