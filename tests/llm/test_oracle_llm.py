"""The registered queries against their DuckDB SQL on whole tables."""

import os
import re

import duckdb
import pytest

from streamlytics.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(rel.project(", ".join(cols)).fetchall())


def test_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for d, _, files in os.walk(os.path.join(root, "streamlytics")):
        for f in files:
            if f.endswith(".py") and os.path.basename(d) != "llm":
                with open(os.path.join(d, f)) as src:
                    assert not re.search(r"\bllm\b", src.read()), f
