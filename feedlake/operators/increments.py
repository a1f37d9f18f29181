"""Incremental feed logic (INC1-INC7), batch form.

A feed page is an ordered list of items; the reference walks it newest
first and ``break``s at the last-seen marker. Here the walk is set-based:

  cut(page)  = min(order) over the items that would stop the walk
  keep(item) = cut is NULL or order < cut

``cut`` is a grouped aggregation (partial aggregation map-side, so a page
holding a third of all items is still combined in parallel) and the keep
test is a join back on the page key, which AQE's skew-join handling splits
when one page dominates. No window function, no per-page sort, no Python.

``order`` is any orderable column ascending in feed position: ``pos`` for
items exploded from one page document, or ``struct(-ts, -id)`` for feeds
stored as rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import splittable_join
from .keyed_tables import KeyedLog

ORD = "_ord"
CUT = "_cut"


def newest_first(ts: str = "ts", tie: str = "event_id") -> Column:
    """Feed order for row-stored feeds: newest first, larger id first."""
    us = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"),
                          F.col(ts).cast("timestamp_ntz"))
    return F.struct((-us).alias("neg_ts"), (-F.col(tie)).alias("neg_tie"))


def _keys(page_cols) -> list[str]:
    return [page_cols] if isinstance(page_cols, str) else list(page_cols)


def apply_cuts(items: DataFrame, cuts: DataFrame, page_cols, inclusive: bool = False) -> DataFrame:
    """Keep items strictly before the page's cut (or up to and including
    it when ``inclusive``). ``items`` must carry ``_ord``; ``cuts`` one row
    per page with ``_cut``."""
    keys = _keys(page_cols)
    # Join on (page, hash(page)): the cut table comes out of an aggregation
    # partitioned by page alone, which no longer satisfies the join's
    # distribution, so both inputs become plain shuffle stages. That is the
    # shape AQE's skew-join handling needs to split a hot page's items (and
    # replicate its single cut row) instead of sending them to one task.
    j = splittable_join(items, cuts, keys, "left")
    before = (F.col(ORD) <= F.col(CUT)) if inclusive else (F.col(ORD) < F.col(CUT))
    return j.where(F.col(CUT).isNull() | before).drop(ORD, CUT)


def take_while(items: DataFrame, page_cols, order: Column, stop: Column,
               inclusive: bool = False) -> DataFrame:
    """Generic take-while: keep each page's items before the first item for
    which ``stop`` holds."""
    keys = _keys(page_cols)
    it = items.withColumn(ORD, order)
    cuts = it.where(stop).groupBy(*keys).agg(F.min(ORD).alias(CUT))
    return apply_cuts(it, cuts, keys, inclusive)


def take_until_seen(items: DataFrame, markers: DataFrame, page_cols, order: Column,
                    key: str, marker_key: str) -> DataFrame:
    """INC2: stop at the first item whose ``key`` equals the page's marker
    (plain equality: no marker, or a NULL key, never cuts). The stop rows
    come from an equi-join on ``(page, key)``, so only matching items move."""
    keys = _keys(page_cols)
    it = items.withColumn(ORD, order)
    m = markers.select(*[F.col(k).alias("_m_" + k) for k in keys],
                       F.col(marker_key).alias("_mk")).where(F.col("_mk").isNotNull())
    cond = [F.col(k) == F.col("_m_" + k) for k in keys] + [F.col(key) == F.col("_mk")]
    stops = it.select(*keys, key, ORD).join(m, cond, "inner")
    cuts = stops.groupBy(*keys).agg(F.min(ORD).alias(CUT))
    return apply_cuts(it, cuts, keys)


def take_while_newer(items: DataFrame, markers: DataFrame, page_cols, order: Column,
                     ts: str, marker_ts: str) -> DataFrame:
    """INC3: stop at the first item with ``ts <= marker`` (marker 0 when the
    page has none)."""
    keys = _keys(page_cols)
    it = items.withColumn(ORD, order)
    m = markers.select(*keys, F.col(marker_ts).alias("_mts"))
    # markers may come out of an aggregation on the page key: see splittable_join
    stops = (splittable_join(it, m, keys, "left")
             .where(F.col(ts) <= F.coalesce(F.col("_mts"), F.lit(0))))
    cuts = stops.groupBy(*keys).agg(F.min(ORD).alias(CUT))
    return apply_cuts(it, cuts, keys)


def heads(items: DataFrame, page_cols, order: Column, cols: list[str]) -> DataFrame:
    """Newest item of each page (first in feed order) as columns
    ``head_<c>``: one aggregation with ``min_by``."""
    keys = _keys(page_cols)
    return (items.withColumn(ORD, order).groupBy(*keys)
            .agg(*[F.min_by(c, F.col(ORD)).alias("head_" + c) for c in cols]))


def page_changed(items: DataFrame, markers: DataFrame, page_cols, order: Column,
                 key: str, marker_key: str, valid: Column | None = None) -> DataFrame:
    """INC4: all-or-nothing. A page whose newest ``key`` equals the marker is
    skipped whole; otherwise every item is new, except that the walk stops at
    the first item failing ``valid`` (e.g. no permalink)."""
    keys = _keys(page_cols)
    h = heads(items, keys, order, [key])
    m = markers.select(*keys, F.col(marker_key).alias("_mk"))
    changed = (h.join(m, keys, "left")
               .where(~F.col("head_" + key).eqNullSafe(F.col("_mk")))
               .select(*keys))
    fresh = splittable_join(items, changed, keys, "left_semi")   # hot page stays splittable
    if valid is None:
        return fresh
    return take_while(fresh, keys, order, ~F.coalesce(valid, F.lit(False)))


def argmax_latest(items: DataFrame, page_cols, ts: str, pos: Column, cols: list[str]) -> DataFrame:
    """INC5: per page, the item with the largest ``ts``; the first in feed
    order wins ties. ``max_by`` over ``struct(ts, -pos)``: an aggregation,
    not a sort."""
    keys = _keys(page_cols)
    o = F.struct(F.col(ts).alias("t"), (-pos).alias("p"))
    return items.groupBy(*keys).agg(*[F.max_by(c, o).alias(c) for c in cols])


def update_markers(markers: DataFrame, items: DataFrame, page_cols, order: Column,
                   key: str, marker_key: str) -> DataFrame:
    """INC1: next marker state. A page seen in this batch takes its newest
    item's key (set only when it differs, which yields the same row); pages
    not seen keep their marker."""
    keys = _keys(page_cols)
    h = heads(items, keys, order, [key]).withColumnRenamed("head_" + key, "_new")
    j = markers.select(*keys, F.col(marker_key).alias("_old")).join(h, keys, "full_outer")
    return j.select(*keys, F.coalesce("_new", "_old").alias(marker_key),
                    (F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old")))
                    .alias("changed"))


def visited_new(candidates: DataFrame, visited: DataFrame, key: str) -> DataFrame:
    """INC6: candidates not yet visited, each once."""
    return candidates.dropDuplicates([key]).join(visited.select(key), key, "left_anti")


def visited_log(spark: SparkSession, path: str, keys: dict[str, str], **kw) -> KeyedLog:
    """INC6 between runs: a visited set whose newest entry of a key decides. A run
    writes what it took, with ``gone`` set for what failed and is to be taken again."""
    return KeyedLog(spark, path, keys, {"gone": "boolean"}, removed="gone", **kw)


# ---------------------------------------------------------------------------
# Array form: when a page's items arrive as one array (one page document =
# one row), the walk is a pure row-local expression: no aggregation, no join
# back, no shuffle beyond the marker lookup.
# ---------------------------------------------------------------------------
def take_until_seen_array(items: Column, key_field: str, last_key: Column) -> Column:
    """INC2 on an item array: the prefix before the first item whose key
    equals ``last_key`` (no marker -> the whole array)."""
    keys = F.transform(items, lambda x: x[key_field])
    at = F.array_position(keys, last_key)            # 1-based, 0 when absent
    return (F.when(last_key.isNull() | (at == 0), items)
            .otherwise(F.slice(items, F.lit(1), at - F.lit(1))))


def take_while_array(items: Column, valid) -> Column:
    """Prefix of items while ``valid(item)`` holds."""
    flags = F.transform(items, lambda x: F.coalesce(valid(x), F.lit(False)))
    at = F.array_position(flags, False)
    return F.when(at == 0, items).otherwise(F.slice(items, F.lit(1), at - F.lit(1)))
