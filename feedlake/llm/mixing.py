"""Mixing to target weights: iterative proportional fitting, then sampling.

Tokens (words ``[^\\x20\\x09-\\x0D]+``) are summed by cell (source, lang, topic).
Raking multiplies every cell so that the sums by source meet the source targets,
then lang, then topic. After every ``BLOCK`` rounds the deviation, the largest share of
its target by which a label's sum is off it, is looked at: raking ends when it is at
most ``TOLERANCE``, when it has fallen by less than ``STANDSTILL`` since the block before
(contradictory targets never get nearer), or after ``MOST_ROUNDS``. The deviation that is
left is a column of the result. A cell's factor is its raked weight over its tokens; a
document is kept with probability min(1, c * factor), c the smallest that is at least
1 / largest factor and at which the expected tokens of the sample are the share ``least``
of all: cells at 1 are kept whole, the others stand to each other as the raked ones do,
and one rare cell with a large factor does not set the size of the sample.

Default targets: shares proportional to tokens to the power ``TEMPER`` in each
dimension, which lifts small sources, languages and topics. A caller may give
shares of its own per dimension. The topic is the first rule of ``TOPICS`` one of
whose words occurs in the lower-cased text, else ``OTHER``.

The cell table is an aggregate over the labels. One of up to ``ONE_TASK`` cells is raked by
window sums in one partition, ``BLOCK`` rounds a job and without a shuffle; a larger one
by sums that combine before their shuffle and a join, checkpointed after every step.
Only scalars reach the driver. Everything is DataFrame expressions.

Defined results: a null source or lang is the empty label; null text has no
words; documents without words take no part (weight and probability 0, not
kept); given targets without tokens are left out and labels without a given
target get weight 0; the draw is the md5 of ``seed:doc_id``, so repeated rows share their fate and
reruns agree (null ``doc_id`` draws as the empty text).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .common import materialise, split_join

TEMPER, SEED, LEAST = 0.85, 17, 0.4
BLOCK, MOST_ROUNDS, TOLERANCE, STANDSTILL = 4, 60, 1e-3, 0.02
#: Cells that are raked in one task.
ONE_TASK = 100_000
DIMS = ("source", "lang", "topic")
#: Default of the parameter ``rules``. Topic rules, in order: name and words of the lower-cased text.
TOPICS = (("tabular", (" | ",)), ("contact", ("@",)), ("legal", ("license", "licence", "copyright")),
          ("noisy", ("%%%", "$$$", "!!")))
OTHER = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column, rules=TOPICS) -> Column:
    low, out = F.lower(text), F.lit(OTHER)
    for name, words in reversed(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, name).otherwise(out)
    return out


def labelled(docs: DataFrame, keep: list | None = None, rules=TOPICS) -> DataFrame:
    """``source, lang, topic, tokens`` of every row, beside the columns ``keep``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(*(keep or []), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in DIMS[:2]],
                       topic(text, rules).alias("topic"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def deviation(cells: DataFrame) -> float:
    """The largest share of its target by which the sum of a label is off it."""
    off = [cells.groupBy(dim).agg(F.sum("w").alias("s"), F.max("t_" + dim).alias("t"))
           .where("t > 0").select((F.abs(F.col("s") - F.col("t")) / F.col("t")).alias("off")) for dim in DIMS]
    return reduce(DataFrame.union, off).agg(F.max("off")).first()[0] or 0.0


def scale_to(factors: DataFrame, budget: float, most: float) -> float:
    """The smallest c of at least 1 / ``most`` with sum(tokens * min(1, c * factor)) >=
    ``budget``. Newton's method on a concave sum of the cells: c only grows, and ends at
    the latest when every cell with a factor is at 1."""
    c, at = 1.0 / most, F.col("factor")
    while True:
        full = at * F.lit(c) >= 1
        whole, rest = factors.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0.0)),
                                  F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * at))).first()
        if not rest or whole + c * rest >= budget * (1 - 1e-12):
            return c
        grown = (budget - whole) / rest
        if grown <= c:
            return c
        c = grown


def _scaled(cells: DataFrame, dim: str, total: Column) -> DataFrame:
    return cells.withColumn("w", F.when(total > 0, F.col("w") * F.col("t_" + dim) / total).otherwise(0.0))


def _rake_block(cells: DataFrame, one_task: bool, rounds: int) -> DataFrame:
    for dim in DIMS * rounds:
        if one_task:
            cells = _scaled(cells, dim, F.sum("w").over(Window.partitionBy(dim)))
        else:
            sums = cells.groupBy(dim).agg(F.sum("w").alias("s"))
            cells = _scaled(split_join(cells, sums, [dim]), dim, F.col("s")).drop("s").checkpoint()
    return cells.checkpoint()


def rake(rows: DataFrame, targets: dict | None = None, temper: float = TEMPER, least: float = LEAST,
         one_task: int = ONE_TASK) -> DataFrame:
    """``source, lang, topic, factor, probability, deviation`` of every cell with
    tokens, from rows ``source, lang, topic, tokens``."""
    if not 0 <= least <= 1:
        raise ValueError("least is a share of the tokens")
    ensure_checkpoint_dir(rows.sparkSession)
    cells = (rows.where("tokens > 0").groupBy(*DIMS).agg(F.sum("tokens").cast("double").alias("tokens"))
             .withColumn("w", F.col("tokens")).checkpoint())
    n, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    for dim in DIMS:
        if targets and dim in targets:
            share = targets[dim].select(dim, F.col("share").cast("double").alias("s"))
            share = cells.select(dim).distinct().join(share, dim, "left").na.fill(0.0, ["s"])
        else:
            share = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(temper)).alias("s"))
        share = share.checkpoint()
        scale = total / (share.agg(F.sum("s")).first()[0] or 1.0) if total else 1.0
        cells = split_join(cells, share.select(dim, (F.col("s") * scale).alias("t_" + dim)), [dim])
    small = n <= one_task
    cells = (cells.coalesce(1) if small else cells).checkpoint()
    done, off, last = 0, float("inf"), float("inf")
    while n and done < MOST_ROUNDS and off > TOLERANCE and (last == float("inf") or off <= (1 - STANDSTILL) * last):
        cells, last = _rake_block(cells, small, BLOCK), off
        done, off = done + BLOCK, deviation(cells)
    factors = cells.select(*DIMS, "tokens", (F.col("w") / F.col("tokens")).alias("factor"))
    most = factors.agg(F.max("factor")).first()[0] or 1.0
    c = scale_to(factors, least * total, most) if total else 1.0
    chance = F.least(F.lit(1.0), F.col("factor") * F.lit(c))
    return materialise(factors.select(*DIMS, "factor", chance.alias("probability"), F.lit(off).alias("deviation")), "mix")


def mix(docs: DataFrame, *, targets: dict | None = None, temper: float = TEMPER, seed: int = SEED, least: float = LEAST,
        rules=TOPICS, one_task: int = ONE_TASK) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, weight, probability, deviation, kept`` for
    every row (``deviation``: by how much the worst label misses its target)."""
    rows = materialise(labelled(docs, ["doc_id"], rules), "mix-labels")
    cells = rake(rows, targets, temper, least, one_task)
    used = F.col("tokens") > 0
    return (split_join(rows, cells, list(DIMS), "left")
            .select("doc_id", *DIMS, "tokens",
                    F.when(used, F.round(F.col("tokens") * F.col("factor"), 6)).otherwise(0.0).alias("weight"),
                    F.when(used, F.round("probability", 9)).otherwise(0.0).alias("probability"),
                    F.when(used, F.round("deviation", 6)).otherwise(0.0).alias("deviation"))
            .withColumn("kept", draw(F.col("doc_id"), seed) < F.col("probability")))


def sample(docs: DataFrame, *, targets: dict | None = None, temper: float = TEMPER, seed: int = SEED, least: float = LEAST,
           rules=TOPICS) -> DataFrame:
    """The kept rows of ``docs``, with all their columns."""
    cells = rake(labelled(docs, None, rules), targets, temper, least)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    asked = labelled(docs, [row, F.col("doc_id").alias("id")], rules).where("tokens > 0")
    # cells come from a written table, so the planner knows their size and
    # broadcasts them only if that is small
    return (split_join(asked, cells, list(DIMS))
            .where(draw(F.col("id"), seed) < F.round("probability", 9)).select("row.*"))


def oracle(temper: float = TEMPER, seed: int = SEED, least: float = LEAST) -> str:
    """DuckDB SQL for ``mix`` over ``documents`` with default targets."""
    low, cases = "lower(coalesce(text, ''))", ""
    for name, words in TOPICS:
        cases += " WHEN " + " OR ".join(f"contains({low}, '{w}')" for w in words) + f" THEN '{name}'"
    parts = [f"""d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
      CASE{cases} ELSE '{OTHER}' END AS topic,
      CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS tokens FROM documents)""",
             "c AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d WHERE tokens > 0 "
             "GROUP BY ALL)"]
    for dim in DIMS:
        parts.append(f"s_{dim} AS (SELECT {dim}, pow(sum(tokens), {temper}) AS s FROM c GROUP BY {dim})")
        parts.append(f"t_{dim} AS (SELECT {dim}, s * (SELECT sum(tokens) FROM c) / (SELECT sum(s) FROM s_{dim}) "
                     f"AS t_{dim} FROM s_{dim})")
    step = f"(SELECT * FROM w WHERE round < {MOST_ROUNDS})"
    for dim in DIMS:
        step = f"(SELECT * REPLACE (w * t_{dim} / sum(w) OVER (PARTITION BY {dim}) AS w) FROM {step})"
    parts.append("w AS (SELECT 0 AS round, c.*, tokens AS w, " + ", ".join(f"t_{x}" for x in DIMS) + " FROM c "
                 + " ".join(f"JOIN t_{x} USING ({x})" for x in DIMS)
                 + f" UNION ALL SELECT * REPLACE (round + 1 AS round) FROM {step})")
    off = " UNION ALL ".join(f"SELECT round, {dim}, abs(sum(w) - max(t_{dim})) / max(t_{dim}) AS off FROM w "
                             f"WHERE round > 0 AND round % {BLOCK} = 0 GROUP BY round, {dim}" for dim in DIMS)
    parts.append(f"o AS (SELECT round, max(off) AS off, lag(max(off)) OVER (ORDER BY round) AS last FROM ({off}) GROUP BY round)")
    parts.append(f"stop AS (SELECT round, off FROM o WHERE off <= {TOLERANCE} OR off > {1 - STANDSTILL} * last "
                 f"OR round = {MOST_ROUNDS} ORDER BY round LIMIT 1)")
    parts.append("f AS (SELECT source, lang, topic, tokens, w / tokens AS factor, off FROM w JOIN stop USING (round))")
    parts.append("""e AS (SELECT factor, sum(tokens) OVER r AS above, sum(tokens * factor) OVER r AS weight_above
      FROM f WINDOW r AS (ORDER BY factor DESC, source, lang, topic))""")
    parts.append(f"""k AS (SELECT coalesce(lag(above) OVER r, 0) AS whole, coalesce(lag(weight_above) OVER r, 0) AS gone, factor,
      {least} * (SELECT sum(tokens) FROM f) AS budget, (SELECT sum(tokens * factor) FROM f) AS weight
      FROM e WINDOW r AS (ORDER BY above))""")
    parts.append("""z AS (SELECT greatest((SELECT 1 / max(factor) FROM f), (SELECT min((budget - whole) / (weight - gone)) FROM k
      WHERE (budget - whole) / (weight - gone) * factor <= 1)) AS c)""")
    parts.append("p AS (SELECT *, least(1.0, factor * (SELECT c FROM z)) AS probability FROM f)")
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, d.tokens,
  CASE WHEN d.tokens > 0 THEN round(d.tokens * factor, 6) ELSE 0.0 END AS weight,
  CASE WHEN d.tokens > 0 THEN round(probability, 9) ELSE 0.0 END AS probability,
  CASE WHEN d.tokens > 0 THEN round(off, 6) ELSE 0.0 END AS deviation,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / {float(16**13)!r}
    < CASE WHEN d.tokens > 0 THEN round(probability, 9) ELSE 0.0 END AS kept
FROM d LEFT JOIN p USING (source, lang, topic)"""
