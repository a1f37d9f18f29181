"""Friend lists as XML documents (GRF3): ``<root total="n"><keyword userID="1"/>...``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RESULT_PARSED, RESULT_RECRAWL

# fixed values: elements and attributes of a friend list page
LIST_SCHEMA = "`_total` BIGINT, `keyword` ARRAY<STRUCT<`_userID`: BIGINT>>, `_broken` STRING"


def parse(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``user_id, xml`` -> edges ``src, dst`` and a status ``user_id, total, result``:
    a list that is no XML document gives no friends and result 2 (taken again), any
    other one, also an empty one, result 1."""
    doc = F.from_xml("xml", LIST_SCHEMA, {"rowTag": "root", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    read = pages.select("user_id", doc.alias("d"))
    broken = F.col("d").isNull() | F.col("d._broken").isNotNull() | F.col("d._total").isNull()
    status = read.select("user_id", F.col("d._total").alias("total"),
                         F.when(broken, RESULT_RECRAWL).otherwise(RESULT_PARSED).alias("result"))
    edges = (read.where(~broken & (F.col("d._total") != 0))
             .select(F.col("user_id").alias("src"), F.explode("d.keyword._userID").alias("dst")).where("dst is not null"))
    return edges, status
