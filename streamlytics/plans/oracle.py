"""DuckDB SQL used as an independent oracle for the batch queries.

Written directly in SQL (window membership by integer arithmetic on epoch
microseconds, ``row_number``, correlated and range joins), not generated from the
Spark plans, so a shared mistake is unlikely.
"""

from __future__ import annotations

US = {"s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}

# events with the same derived columns as sources.testdata.events
EVENTS = ("SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us, event_id AS seq, "
          "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")

USER_BEHAVIOR = (f"SELECT user_id, k AS item_id, CAST(k % 10 AS INTEGER) AS category_id, "
                 f"CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' "
                 f"WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav' ELSE event_type END AS behavior, "
                 f"ts_us, seq FROM ({EVENTS})")

AD_CLICKS = (f"SELECT e.user_id, e.k AS ad_id, r.r_name AS province, n.n_name AS city, e.ts_us, e.seq "
             f"FROM ({EVENTS}) e JOIN customer c ON e.user_id = c.c_custkey "
             f"JOIN nation n ON c.c_nationkey = n.n_nationkey "
             f"JOIN region r ON n.n_regionkey = r.r_regionkey WHERE e.event_type = 'click'")

MARKETING = (f"SELECT user_id, CASE event_type WHEN 'view' THEN 'BROWSE' WHEN 'click' THEN 'CLICK' "
             f"WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'INSTALL' WHEN 'error' THEN 'UNINSTALL' "
             f"ELSE event_type END AS behavior, "
             f"(['appstore','xiaomistore','huaweistore','weibo','wechat','tieba'])[k % 6 + 1] AS channel, "
             f"ts_us, seq FROM ({EVENTS})")

LOGIN = (f"SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, "
         f"ts_us, seq FROM ({EVENTS})")

ORDERS = (f"SELECT user_id AS order_id, CASE event_type WHEN 'signup' THEN 'create' "
          f"WHEN 'purchase' THEN 'pay' ELSE event_type END AS event_type, ts_us, seq FROM ({EVENTS})")

ACCESS_LOG = (f"SELECT printf('10.%d.%d.%d', (user_id // 65536) % 256, (user_id // 256) % 256, user_id % 256) AS ip, "
              f"'u' || CAST(user_id AS VARCHAR) AS user_id, (ts_us // 1000000) * 1000 AS ts_ms, "
              f"CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method, "
              f"'/p/' || CAST(k AS VARCHAR) || (['.css','.js','.html','.json',''])[k % 5 + 1] AS url "
              f"FROM ({EVENTS})")


def sliding(src: str, keys: list[str], size_us: int, slide_us: int) -> str:
    """Counts per key and window [end - size, end), end a multiple of slide (ms bounds)."""
    kk = ", ".join(keys)
    ksel = (kk + ", ") if keys else ""
    n = size_us // slide_us
    return (f"SELECT {ksel}(we - {size_us}) // 1000 AS window_start, we // 1000 AS window_end, "
            f"CAST(count(*) AS BIGINT) AS cnt FROM (SELECT {ksel}(ts_us // {slide_us} + 1 + g) * {slide_us} AS we "
            f"FROM ({src}) s, range(0, {n}) r(g)) x GROUP BY {ksel}we")


def topn(counts: str, key: str, n: int) -> str:
    return (f"SELECT window_end, rank, {key}, cnt FROM (SELECT window_end, {key}, cnt, "
            f"row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS rank "
            f"FROM ({counts}) c) t WHERE rank <= {n}")
