"""Date helpers (FN4-FN6). Every helper takes an explicit zone and works on
TIMESTAMP_NTZ arithmetic, so results do not depend on the session zone."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# Fixed formats used by the platforms.
FMT_TASK = "yyyyMMddHHmmss"
FMT_ACTION = "yyyy-MM-dd HH:mm"
FMT_DAY = "yyyy-MM-dd"
FMT_CN = "yyyy年MM月dd日 HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def millis_to_ntz(ms, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in ``zone``."""
    utc_wall = F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), _c(ms).cast("decimal(20,3)") / F.lit(1000))
    if zone == "UTC":
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def ntz_to_millis(ts, zone: str = "UTC") -> Column:
    """Wall-clock TIMESTAMP_NTZ in ``zone`` -> epoch milliseconds."""
    ts = _c(ts)
    if zone != "UTC":
        ts = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def millis_to_string(ms, fmt: str = FMT_TASK, zone: str = "UTC") -> Column:
    """FN4: epoch ms -> formatted wall clock in ``zone``."""
    return F.date_format(millis_to_ntz(ms, zone), fmt)


def string_to_millis(s, fmt: str, zone: str = "UTC") -> Column:
    """FN5/FN6: parse ``s`` with ``fmt`` (strict; NULL on failure) as a
    wall clock in ``zone`` and return epoch ms."""
    wall = F.try_to_timestamp(_c(s), F.lit(fmt)).cast("timestamp_ntz")
    return ntz_to_millis(wall, zone)
