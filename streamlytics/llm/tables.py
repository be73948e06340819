"""Reading the given tables, written intermediate tables, and task-side imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path, ship_package


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``: it is
    computed once, read as often as needed, and survives the loss of any executor."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many marks behind it as it takes not to clash with a column
    of ``df`` (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def null_safe(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str) -> DataFrame:
    """Join on ``left.key <=> right.value``: rows with null keys keep their partners."""
    cond = None
    for a, b in keys.items():
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)
