"""S5 side outputs: one DataFrame with an ``output`` tag column instead of tagged
secondary streams. ``split`` gives one filtered view per tag; ``write_split``
writes all tags in one job (``partitionBy``), so the plan runs once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split(df: DataFrame, tag_col: str = "output", tags=None) -> dict[str, DataFrame]:
    tags = tags or []
    return {t: df.filter(F.col(tag_col) == t).drop(tag_col) for t in tags}


def write_split(df: DataFrame, path: str, tag_col: str = "output", mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).partitionBy(tag_col).save(path)
