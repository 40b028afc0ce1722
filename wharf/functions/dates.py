"""Date functions (F1-F7). Epoch milliseconds in, strings out, in an explicit zone.

The session zone never takes part: epoch ms become a zone-free (NTZ) wall time at UTC, which
``convert_timezone`` moves to ``tz``; strings come from casting NTZ/DATE values (zone-free), and epoch
ms come back from date and time-of-day fields. ``tz`` is used both to format and to parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wharf.config import DEFAULT_TZ

DAY_MS = 24 * 60 * 60 * 1000
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _ntz_of_ms(ms: Column | str) -> Column:
    """Epoch ms -> the UTC wall time as TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))


def epoch_ms_of(ts_ntz: Column | str) -> Column:
    """Epoch ms of a zone-free timestamp read as UTC: floor of microseconds / 1000, computed from the
    date and time-of-day fields so no cast to a zoned timestamp happens."""
    t = _c(ts_ntz)
    days = F.unix_date(t.cast("date")).cast("bigint")
    tod_ms = (F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * 1000
    sec_ms = F.floor(F.date_part(F.lit("SECOND"), t) * 1000).cast("bigint")
    return days * DAY_MS + tod_ms + sec_ms


def _local_ntz(ms: Column | str, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _ntz_of_ms(ms))


def ts_to_date(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F2 ``tsToDate``: epoch ms -> ``yyyy-MM-dd`` in ``tz``."""
    return _local_ntz(ms, tz).cast("date").cast("string")


def ts_to_date_time(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F3 ``tsToDateTime``: epoch ms -> ``yyyy-MM-dd HH:mm:ss`` in ``tz``."""
    return F.substring(_local_ntz(ms, tz).cast("string"), 1, 19)


def ts_to_date_for_partition(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F4 ``tsToDateForPartition``: epoch ms -> ``yyyyMMdd`` in ``tz``."""
    return F.translate(ts_to_date(ms, tz), "-", "")


def prev_day(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """the date of ``ms - 24h`` (not ``date_sub``: the two differ across clock changes)."""
    return ts_to_date(_c(ms) - F.lit(DAY_MS), tz)


def date_time_to_ts(s: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F1 ``dateTimeToTs``: ``yyyy-MM-dd HH:mm:ss`` wall time in ``tz`` -> epoch ms; NULL on bad text."""
    # Parse the wall time pinned at +00:00, so the session zone plays no part, then move it from tz.
    wall_ms = F.unix_millis(F.try_to_timestamp(F.concat(_c(s), F.lit("+00:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX")))
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), _ntz_of_ms(wall_ms))
    return epoch_ms_of(utc)


def date_to_ts(d: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F5 ``dateToTs``: ``yyyy-MM-dd`` -> epoch ms of its midnight in ``tz``."""
    return date_time_to_ts(F.concat(_c(d), F.lit(" 00:00:00")), tz)


def proc_time() -> Column:
    """F7 ``PROCTIME()``: processing time, fixed per query or micro-batch."""
    return F.current_timestamp()
