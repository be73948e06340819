"""Scalar column functions (JVM-side expressions only; no Python UDFs)."""

from .time import (epoch_us, epoch_ms_to_ntz, format_window_time, format_sql_time,
                   parse_log_time, next_midnight_us, US_PER, duration_us)
from .hashing import poly_hash_mask
from .text import split_fields, drop_static_resources, tx_present

__all__ = [
    "epoch_us", "epoch_ms_to_ntz", "format_window_time", "format_sql_time", "parse_log_time",
    "next_midnight_us", "US_PER", "duration_us", "poly_hash_mask",
    "split_fields", "drop_static_resources", "tx_present",
]
