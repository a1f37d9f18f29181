"""JSON / numeric-text helpers (FN11, FN12)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_get_or_default(j, key: str, default: str = "") -> Column:
    """FN12 ``getOrElse(key, default)``: a missing key (or unparsable
    document) gives ``default``; a key holding JSON null stays NULL."""
    v = F.try_parse_json(_c(j))
    raw = F.try_variant_get(v, F.lit("$." + key), "variant")
    return F.when(raw.isNull(), F.lit(default)).otherwise(
        F.try_variant_get(v, F.lit("$." + key), "string"))


def try_int(s) -> Column:
    return _c(s).try_cast("int")


def try_long(s) -> Column:
    return _c(s).try_cast("bigint")


def try_double(s) -> Column:
    return _c(s).try_cast("double")


def json_int_or_default(j, key: str, default: int = 0) -> Column:
    """``getOrElse(key, "0").toInt`` with bad numbers mapped to NULL."""
    return try_int(json_get_or_default(j, key, str(default)))
