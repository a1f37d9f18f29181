"""Profile fields from platform JSON (PROF6, PROF8)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import json_get_or_default, json_int_or_default


def vip_portrait(image: Column) -> Column:
    """Portrait address of a 40001 profile: prefix + image name without the size suffix."""
    return F.concat(F.lit(schemas.URLS[40001]["vip_image"]),
                    F.replace(image, F.lit(schemas.VIP_IMAGE_SUFFIX), F.lit("")))


def vip_info(rows: DataFrame, col: str) -> DataFrame:
    """All fields of a 40004 user-info document; missing text is '', missing numbers 0."""
    uid = json_get_or_default(col, "userID")
    return rows.select(
        uid.alias("user_id"), json_get_or_default(col, "userName").alias("name"),
        json_get_or_default(col, "fansNum", "0").try_cast("int").alias("followers_count"),
        json_get_or_default(col, "pe").alias("introduction"),
        json_int_or_default(col, "be").alias("marrow"), json_int_or_default(col, "us").alias("recommend"),
        json_int_or_default(col, "vipAuth").alias("vip"),
        F.concat(F.lit(schemas.URLS[40004]["blog"]), uid).alias("home_page"),
        F.concat(F.lit(schemas.URLS[40004]["image"]), json_get_or_default(col, "pr")).alias("portrait"))
