"""Top-N per window (K1 K2) and the text rendering of a ranking (K3).

``row_number() ... <= n`` is planned by Spark with a *partial* window-group limit
before the shuffle (``WindowGroupLimit``), so every map task forwards at most
``n`` rows per window end: a window with millions of distinct items never meets
in one task. Spark plans that limit only up to
``spark.sql.optimizer.windowGroupLimitThreshold`` ranks (1,000); for more, a group is ranked
in ``PARTS`` parts by hash first, and the parts' first ``n`` again, so that no task sorts more
than a ``PARTS``-th of a group or ``PARTS`` times n rows. Ties are broken by the item key ascending (the reference keeps
arrival order, which a DataFrame does not have).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


PARTS = 16


def top_n(df: DataFrame, group_cols: str | Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows per group by ``order``; adds a bigint ``rank`` (1-based)."""
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        whole = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")])
        parted = df.withColumn("_part", F.pmod(whole, F.lit(PARTS)))
        first = parted.withColumn(rank_col, F.row_number().over(W.partitionBy(*g, "_part").orderBy(*order)))
        df = first.filter(F.col(rank_col) <= n).drop("_part", rank_col)
    w = W.partitionBy(*g).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def top_n_by_count(counts: DataFrame, key: str, n: int, window_col: str = "window_end",
                   count_col: str = "cnt") -> DataFrame:
    """K1/K2: top ``n`` keys per window end by count descending, key ascending."""
    return top_n(counts, window_col, [F.col(count_col).desc(), F.col(key).asc()], n).select(
        window_col, "rank", key, count_col)


# The text of the reference's ranking blocks (K3).
ITEM_REPORT = {"head": None, "time": "时间：", "line": "No{rank}: 商品ID={key} 浏览量={cnt}",
               "rule": "================================", "tail": ""}
URL_REPORT = {"head": "=================================", "time": "时间：",
              "line": "NO{rank}: URL={key} 流量={cnt}", "rule": "=============================",
              "tail": "\n\n"}


def render_ranking(ranked: DataFrame, key: str, labels: dict = ITEM_REPORT,
                   window_col: str = "window_end", count_col: str = "cnt") -> DataFrame:
    """K3: one text block per window end: time line, one line per rank, rule.

    The group is at most ``n`` rows (input is already top-n), so collecting it is bounded.
    """
    from ..functions.time import format_sql_time
    pre, mid = labels["line"].split("{rank}")[0], labels["line"].split("{rank}")[1]
    key_lbl = mid.split("{key}")[0]
    cnt_lbl = mid.split("{key}")[1].split("{cnt}")[0]
    line = F.concat(F.lit(pre), F.col("rank").cast("string"), F.lit(key_lbl),
                    F.col(key).cast("string"), F.lit(cnt_lbl), F.col(count_col).cast("string"))
    lines = F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("l"))))
    head = [F.lit(labels["head"])] if labels.get("head") else []
    body = F.concat_ws("\n", *head, F.concat(F.lit(labels["time"]), format_sql_time(F.col(window_col))),
                       F.concat_ws("\n", F.transform("_ls", lambda s: s["l"])), F.lit(labels["rule"]))
    return (ranked.groupBy(window_col)
            .agg(lines.alias("_ls"))
            .select(window_col, F.concat(body, F.lit(labels.get("tail") or "")).alias("report")))
