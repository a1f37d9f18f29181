"""URL helpers (FN7, FN8, MSG8)."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_segment(url) -> Column:
    """FN7: last '/'-separated part, trailing slashes ignored."""
    return F.element_at(F.split(F.regexp_replace(_c(url), "/+$", ""), "/"), -1)


def after_marker(s, marker: str) -> Column:
    """FN8 ``split(marker)(1)``: text between the first and second marker;
    NULL when the marker is absent."""
    parts = F.split(_c(s), re.escape(marker))
    return F.when(F.size(parts) > 1, F.element_at(parts, 2))


def before_marker(s, marker: str) -> Column:
    """FN8 ``split(marker)(0)``."""
    return F.split(_c(s), re.escape(marker)).getItem(0)


def query_param(url, key: str) -> Column:
    """Value of ``key=`` in the url ('' when present and empty, NULL if absent)."""
    return F.when(F.instr(_c(url), key + "=") > 0,
                  F.regexp_extract(_c(url), re.escape(key) + "=([^&#]*)", 1))


def numeric_id(url) -> Column:
    """First run of digits after a '/' in the url path (page owner id)."""
    return F.regexp_extract(_c(url), r"/([0-9]+)", 1)
