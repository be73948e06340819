"""Batch operators (DataFrame in, DataFrame out); most also accept streams where noted."""

from .detect import click_cap, login_fail_arrival, order_pay_outcomes
from .dims import bounded_broadcast
from .distinct import (approx_unique_visitors, bitmap_distinct, bitmap_unique_visitors,
                       running_unique_visitors, unique_visitors)
from .joins import interval_join, reconcile
from .outputs import split, write_split
from .patterns import followed_by_within, strict_pair
from .sequence import choose_width, running_sum, seq_bucket, time_bucket, with_neighbor
from .topn import render_ranking, top_n, top_n_by_count
from .windows import integer_average, sliding_count, tumbling_count, window_agg

__all__ = [
    "click_cap", "login_fail_arrival", "order_pay_outcomes", "bounded_broadcast",
    "approx_unique_visitors", "bitmap_distinct", "bitmap_unique_visitors", "running_unique_visitors",
    "unique_visitors", "interval_join", "reconcile", "split", "write_split", "followed_by_within",
    "strict_pair", "choose_width", "running_sum", "seq_bucket", "time_bucket", "with_neighbor",
    "render_ranking", "top_n", "top_n_by_count", "integer_average", "sliding_count", "tumbling_count",
    "window_agg",
]
