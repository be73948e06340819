"""Event-time helpers.

Time is carried as integer epoch microseconds (``ts_us``) inside operators: window
and pane arithmetic is then plain integer math that stays in whole-stage codegen
and does not depend on the session time zone. Timestamps are rebuilt only at the
edges (watermarks, formatting).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Units accepted by duration strings ("5 seconds", "1 hour", "15 min", ...).
US_PER = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_us(d: str | int) -> int:
    """'1 hour' / '5 seconds' / 300_000_000 -> microseconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in US_PER:
        raise ValueError(f"bad duration: {d!r}")
    return int(m.group(1)) * US_PER[m.group(2).lower()]


def epoch_us(col: str | Column, dtype=None) -> Column:
    """Epoch microseconds of a timestamp column.

    ``TIMESTAMP_NTZ`` is measured against the NTZ epoch (zone-free); ``TIMESTAMP``
    is an instant and uses ``unix_micros``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return _ntz_us(c) if isinstance(dtype, TimestampNTZType) else F.unix_micros(c)


def _ntz_us(c: Column) -> Column:
    """Microseconds of a TIMESTAMP_NTZ since the epoch, its wall clock read as UTC. Made
    of the clock's own fields, so the session zone has no part in it."""
    seconds = F.unix_date(F.to_date(c)) * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return (seconds.cast("bigint") * 1_000_000
            + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint"))


def epoch_ms_to_ntz(ms_col: str | Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ wall clock in UTC (zone-free formatting)."""
    c = F.col(ms_col) if isinstance(ms_col, str) else ms_col
    return _ntz_plus_ms(c)


def _ntz_plus_ms(c: Column) -> Column:
    # timestampadd(MILLISECOND, ms, epoch_ntz) keeps the value zone-free.
    return F.timestamp_add("MILLISECOND", c, F.expr(_EPOCH_NTZ))


# Fixed output formats of the reference jobs.
WINDOW_TIME_FORMAT = "yyyy/MM/dd-HH:mm:ss"      # window bounds in the ad / marketing reports
SQL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.S"       # java.sql.Timestamp text of a whole-second instant
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"         # time field of the web access log


def format_window_time(ms_col: str | Column) -> Column:
    """epoch ms -> 'yyyy/MM/dd-HH:mm:ss' (UTC)."""
    c = F.col(ms_col) if isinstance(ms_col, str) else ms_col
    return F.date_format(_ntz_plus_ms(c), WINDOW_TIME_FORMAT)


def format_sql_time(ms_col: str | Column) -> Column:
    """epoch ms (whole seconds) -> 'yyyy-MM-dd HH:mm:ss.0' (UTC)."""
    c = F.col(ms_col) if isinstance(ms_col, str) else ms_col
    return F.date_format(_ntz_plus_ms(c), SQL_TIME_FORMAT)


def parse_log_time(col: str | Column) -> Column:
    """F2: 'dd/MM/yyyy:HH:mm:ss' (UTC wall clock) -> epoch microseconds."""
    c = F.col(col) if isinstance(col, str) else col
    return _ntz_us(F.to_timestamp_ntz(c, F.lit(LOG_TIME_FORMAT)))


def next_midnight_us(us_col: str | Column) -> Column:
    """first UTC midnight strictly after the instant (epoch microseconds)."""
    c = F.col(us_col) if isinstance(us_col, str) else us_col
    day = F.lit(US_PER["day"])
    return c - F.pmod(c, day) + day
