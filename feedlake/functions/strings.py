"""String helpers (FN1-FN3, FN10, ART8)."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def intercept(s, n: int, exact_len_empty: bool = False) -> Column:
    """FN1: first ``n`` chars when longer than ``n``; the string itself when
    shorter. A string of exactly ``n`` chars (or ``n < 0``) gives "" under the
    reference rule (``exact_len_empty=True``); the pipeline default keeps it.
    NULL stays NULL."""
    s = _c(s)
    ln = F.length(s)
    if n >= 0:
        res = (F.when(ln > n, F.substring(s, 1, n))
               .when(ln < n, s)
               .otherwise(F.lit("") if exact_len_empty else s))
    else:
        res = F.when(s.isNotNull(), F.lit(""))
    return F.when(s.isNotNull(), res)


def cut(s, n: int) -> Column:
    """Plain "first n chars if longer" (the back-fill jobs' cut)."""
    return F.substring(_c(s), 1, n)


def before_first(s, sign: str) -> Column:
    """FN2: text before the first ``sign``; the whole string if absent."""
    return F.substring_index(_c(s), sign, 1)


def before_last(s, sign: str) -> Column:
    """FN3: text before the last ``sign``; the whole string if absent."""
    s = _c(s)
    tail = F.substring_index(s, sign, -1)
    keep = F.length(s) - F.length(tail) - F.lit(len(sign))
    return F.when(F.instr(s, sign) > 0, F.substring(s, F.lit(1), keep)).otherwise(s)


def strip_tags(s) -> Column:
    """ART8: remove every ``<...>`` tag."""
    return F.regexp_replace(_c(s), "<[^>]*>", "")


def literal_split_first(s, sep: str) -> Column:
    """Text before the first literal ``sep`` (FEED5a quote cut, Q1 fixed)."""
    return F.split(_c(s), re.escape(sep)).getItem(0)
