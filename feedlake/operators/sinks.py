"""Sinks (SNK1-SNK11): idempotent table writes and task emission.

Tables are Parquet folders (a lakehouse format with MERGE is not available
here); every write is expressed as "compute the next version of the table
as a DataFrame, then write it", which is replay-safe inside
``foreachBatch``: re-running a batch recomputes the same version.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import splittable_join


# ---------------------------------------------------------------- tasks
def stamp_id_ms() -> Column:
    """Clock id added at the sink, never inside a proof query."""
    return F.unix_millis(F.current_timestamp())


def write_tasks(tasks: DataFrame, path: str, col: str = "task", fmt: str = "text", **options) -> None:
    """SNK1/SNK2: one JSON value per task. ``fmt='kafka'`` with
    ``kafka.bootstrap.servers`` / ``topic`` options sends them to a topic;
    the default lands text files (the batching is the writer's)."""
    out = tasks.select(F.col(col).alias("value"))
    if fmt == "kafka":
        out.write.format("kafka").options(**options).save()
    else:
        out.write.mode("append").format(fmt).options(**options).save(path)


def with_clock_id(task_json: Column) -> Column:
    """``{"id":<now ms>, ...}`` for article tasks at the sink."""
    return F.concat(F.lit('{"id":'), stamp_id_ms().cast("string"), F.lit(","),
                    F.substring(task_json, 2, 1 << 30))


# ---------------------------------------------------------------- typed appends
def conform(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """SNK3/SNK4: declared column list and types (a missing column is a
    typed NULL, never an unbound parameter)."""
    cols = []
    for name, typ in schema:
        c = F.col(name) if name in df.columns else F.lit(None)
        cols.append(c.cast(typ).alias(name))
    return df.select(*cols)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ---------------------------------------------------------------- upserts
def insert_if_absent(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """SNK5: rows of ``incoming`` whose key is not in ``existing``, each key
    once: of several rows the smallest by the remaining columns in order."""
    rest = [c for c in incoming.columns if c not in keys]
    once = incoming.select(*keys).distinct() if not rest else (
        incoming.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_f")).select(*keys, "_f.*"))
    return once.select(*incoming.columns).join(existing.select(*keys), keys, "left_anti")


def read_if_exists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A written table, or no rows where nothing was written yet. Any other
    failure to read it is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def keyed_update(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """SNK6/SNK7: next version of ``target`` with ``cols`` replaced where the
    key matched (a ``matched`` flag, not coalesce, so NULL can be written).
    Updates are assumed unique per key (one UPDATE per key)."""
    u = updates.select(*keys, *[F.col(c).alias("_u_" + c) for c in cols]).withColumn("_m", F.lit(True))
    j = splittable_join(target, u, keys, "left")
    out = [F.when(F.col("_m").isNotNull(), F.col("_u_" + c)).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in target.columns]
    return j.select(*out, F.coalesce("_m", F.lit(False)).alias("updated"))


# ---------------------------------------------------------------- versioned tables
# <path>/version=<n>: a table that is made anew as a whole (SNK9); readers see the
# newest version. Updates and puts by key are in ``keyed_tables.BucketTable``.
def put_version(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest version (of those below ``before``), without the version column."""
    t = spark.read.parquet(path)
    if before is not None:
        t = t.where(F.col("version") < before)
    return t.where(F.col("version") == t.agg(F.max("version")).scalar()).drop("version")


def create_or_replace(df: DataFrame, path: str, keep: int, key: str, ts: str, version: int) -> None:
    """SNK9: (re)creates a table that holds the newest ``keep`` rows of each key."""
    put_version(keep_versions(df, key, F.col(ts), keep), path, version)


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int,
                  salt_buckets: int = 64, salt_of: Column | None = None) -> DataFrame:
    """Exact top-n rows per key, skew-safe: rank first within
    ``(key, salt)`` sub-groups (a hot key is split ``salt_buckets`` ways),
    keep n per sub-group, then rank the at most ``n * salt_buckets``
    survivors per key."""
    salt = salt_of if salt_of is not None else F.pmod(F.xxhash64(*df.columns), F.lit(salt_buckets))
    s = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    pre = s.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n).drop("_r1", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return pre.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= n).drop("_r")


def keep_versions(versions: DataFrame, key: str, ts: Column, n: int = 3) -> DataFrame:
    """SNK9: retention = the newest ``n`` versions per key."""
    return top_n_per_key(versions, [key], [ts.desc()], n)
