"""Positional splitting and the string filters of the reference jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a URL is a static resource when it ends in .css or .js.
STATIC_RESOURCE_PATTERN = r"\.(css|js)$"


def split_fields(col: str | Column, sep: str = ",") -> Column:
    """split a delimited line into an array of fields (regex-quoted separator)."""
    import re
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, re.escape(sep))


def drop_static_resources(url: str | Column) -> Column:
    """Predicate keeping URLs that do not end in .css / .js."""
    c = F.col(url) if isinstance(url, str) else url
    return ~c.rlike(STATIC_RESOURCE_PATTERN)


def tx_present(tx: str | Column) -> Column:
    """A transaction id is present (CSV readers turn empty fields into NULL)."""
    c = F.col(tx) if isinstance(tx, str) else tx
    return c.isNotNull() & (F.trim(c) != "")
