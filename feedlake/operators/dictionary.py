"""Dictionary lookups as joins (FN9 / NLP7 at scale).

The reference holds a name -> aliases dictionary as a broadcast map and
looks every name up in a loop. Here the name list is exploded, joined to the
dictionary table and re-assembled per row in list order. Whether the
dictionary is broadcast is left to Spark, which decides by its size in bytes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import splittable_join


def stock_pairs_join(df: DataFrame, id_col: str, names_col: str, dictionary: DataFrame,
                     out: str = "stock") -> DataFrame:
    """``names`` (comma list) -> ``name=code&...`` where code is the first
    alias that differs from the name. A name absent from the dictionary (or
    without another alias) fails the whole row -> NULL, as the reference's
    map lookup throws and skips the row. Empty / NULL lists give NULL."""
    d = dictionary.select(F.col("name").alias("_name"),
                          F.filter("aliases", lambda x: x != F.col("name")).getItem(0).alias("_code"))
    ex = df.select(id_col, F.posexplode(F.split(names_col, ",")).alias("_i", "_name"))
    j = splittable_join(ex, d, ["_name"], "left")
    pair = F.concat(F.col("_name"), F.lit("="), F.col("_code"))
    agg = j.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_i"), pair.alias("p")))).alias("_ps"),
        F.count(F.lit(1)).alias("_n"), F.count(pair).alias("_ok"))
    return agg.select(id_col, F.when(F.col("_n") == F.col("_ok"),
                                     F.array_join(F.transform("_ps", lambda s: s["p"]), "&"))
                      .alias(out))
