"""Column -> Column helpers (all JVM-side built-in expressions)."""
from .strings import (intercept, before_first, before_last, strip_tags, cut,
                      literal_split_first)
from .dates import millis_to_string, string_to_millis, ntz_to_millis, millis_to_ntz
from .urls import last_segment, after_marker, before_marker, query_param, numeric_id
from .jsonx import json_get_or_default, json_int_or_default, try_int, try_long, try_double

__all__ = [
    "intercept", "before_first", "before_last", "strip_tags", "cut", "literal_split_first",
    "millis_to_string", "string_to_millis", "ntz_to_millis", "millis_to_ntz",
    "last_segment", "after_marker", "before_marker", "query_param", "numeric_id",
    "json_get_or_default", "json_int_or_default", "try_int", "try_long", "try_double",
]
