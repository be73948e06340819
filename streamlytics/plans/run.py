"""Run one of the reference's jobs on its own kind of input, as its ``main`` did.

    spark-submit --py-files streamlytics.zip streamlytics/plans/run.py JOB \\
        --input PATH [--input2 PATH] [--output DIR] [--stream] [--param key=value ...]

Inputs are the jobs' CSV files (or folders; ``apache.log``-style text for
``network_flow``); ``--stream`` reads them as file streams (new files are new
micro-batches) for the jobs that have a streaming form. With ``--output`` every
output is written as Parquet under DIR/<output name>, tagged ones (main and side
outputs) in one job under DIR/output=<tag>; without it a preview of each output is printed (the reference's ``print``).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from streamlytics.functions.text import tx_present  # noqa: E402
from streamlytics.operators.outputs import split, write_split  # noqa: E402
from streamlytics.plans import jobs  # noqa: E402
from streamlytics.sources.access_log import read_access_log, read_access_log_stream  # noqa: E402
from streamlytics.sources.records import read_records, read_records_stream  # noqa: E402


def _pays(orders: DataFrame) -> DataFrame:
    # only the transaction id is filtered, so rows of other types with an id take part
    return orders.filter(tx_present("tx_id")).select("tx_id", "order_id", "event_type",
                                                     F.col("ts_us").alias("pay_us"))


def _receipts(r: DataFrame) -> DataFrame:
    return r.select("tx_id", "pay_channel", F.col("ts_us").alias("receipt_us"))


class Tagged:
    """Main and side outputs of one plan, told apart by the column ``output``."""

    def __init__(self, df: DataFrame, tags):
        self.df, self.tags = df, list(tags)

    def views(self) -> dict:
        return split(self.df, tags=self.tags)

    def write(self, path: str) -> dict:
        """All outputs in one job, under PATH/output=<tag>; returned as tables."""
        write_split(self.df, path)
        made = self.df.sparkSession.read.schema(self.df.schema).parquet(path)
        return split(made, tags=self.tags)


# job -> (input kinds, batch function returning {output name: DataFrame})
BATCH = {
    "hot_items": (["user_behavior"], lambda d, p: {"report": jobs.hot_items_report(jobs.hot_items(d[0], **p))}),
    "network_flow": (["access_log"], lambda d, p: {"report": jobs.hot_urls_report(jobs.hot_urls(d[0], **p))}),
    "page_view": (["user_behavior"], lambda d, p: {"pv": jobs.page_views(d[0], **p)}),
    "unique_visitor": (["user_behavior"], lambda d, p: {"uv": jobs.unique_visitors(d[0], **p)}),
    "uv_with_bloom": (["user_behavior"], lambda d, p: {"uv": jobs.unique_visitors_bitmap_running(d[0], **p)}),
    "ad_statistics_by_geo": (["ad_click"], lambda d, p: {"count": jobs.ad_count_by_province(d[0], **p)}),
    "blacklist_warning": (["ad_click"], lambda d, p: _blacklist(d[0], p)),
    "app_marketing_by_channel": (["marketing"], lambda d, p: {"count": jobs.marketing_by_channel(d[0], **p)}),
    "app_marketing_statistics": (["marketing"], lambda d, p: {"count": jobs.marketing_total(d[0], **p)}),
    "login_fail": (["login"], lambda d, p: {"warning": jobs.login_fail_state(d[0], **p)}),
    "login_fail_with_cep": (["login"], lambda d, p: {"warning": jobs.login_fail_cep(d[0], **p)}),
    "order_timeout": (["order"], lambda d, p: Tagged(jobs.order_timeout_cep(d[0], **p), ["matched", "timeout"])),
    "order_timeout_without_cep": (["order"], lambda d, p: Tagged(jobs.order_timeout_state(d[0], **p),
                                                                  ["payed", "timeout"])),
    "tx_match_detect": (["order", "receipt"], lambda d, p: Tagged(jobs.tx_match(_pays(d[0]), _receipts(d[1]), **p),
                                                                   ["matched", "unmatched_pay", "unmatched_receipt"])),
    "tx_match_by_join": (["order", "receipt"], lambda d, p: {"matched": jobs.tx_match_by_join(
        _pays(d[0]), _receipts(d[1]), **p)}),
}


def _blacklist(clicks: DataFrame, p: dict) -> dict:
    cap = {k: p.pop(k) for k in ("keys", "cap", "reset") if k in p}
    tagged = jobs.blacklist_filter(clicks, **cap)
    return {"count": jobs.ad_count_by_province(tagged.filter(F.col("output") == "pass"), **p),
            "blacklist": tagged.filter(F.col("output") == "warn").select("user_id", "ad_id", "msg")}


def _read(spark: SparkSession, kind: str, path: str, stream: bool, arrival: bool = False) -> DataFrame:
    if kind == "access_log":
        return read_access_log_stream(spark, path) if stream else read_access_log(spark, path)
    return read_records_stream(spark, path, kind, arrival=arrival) if stream else read_records(spark, path, kind)


def _stream_outputs(job: str, d: list, p: dict) -> dict:
    from streamlytics.streaming import jobs as SJ
    from streamlytics.streaming import state as ST
    from streamlytics.streaming.core import with_event_time
    delay = {"network_flow": "1 second", "login_fail_with_cep": "5 seconds"}.get(job, "0 seconds")
    # The arrival sequence is read for the job that goes by it; the event-time jobs only use
    # it to break ties, which are then left unordered (a queue's offset is used when present).
    d = [x if "seq" in x.columns else x.withColumn("seq", F.col("ts_us")) for x in d]
    capped = {k: p[k] for k in ("keys", "cap", "reset") if k in p}
    sliding = {k: p[k] for k in ("size", "slide") if k in p}
    if job == "tx_match_detect":
        return {"result": ST.stream_tx_match(_pays(d[0]), _receipts(d[1]), "tx_id", p.get("wait", "5 seconds"), "pay_us", "receipt_us",
                                             max_ts_us=p.get("max_ts_us"))}
    if job == "tx_match_by_join":
        # each side gets its own event-time column and watermark
        pays = with_event_time(_pays(d[0]), "pay_us", "0 seconds", "pay_ts", p.get("max_ts_us"))
        recs = with_event_time(_receipts(d[1]), "receipt_us", "0 seconds", "receipt_ts", p.get("max_ts_us"))
        j = SJ.stream_interval_join(pays, recs, "tx_id", p.get("lower", "-5 seconds"), p.get("upper", "5 seconds"),
                                    "pay_ts", "receipt_ts")
        return {"result": j.drop("pay_ts", "receipt_ts")}
    # max_ts_us: optional guard against impossible future event times (they would push
    # the watermark past all real data)
    d = [with_event_time(x, "ts_us", delay, max_ts_us=p.get("max_ts_us")) for x in d]
    if job == "hot_items":
        counts, rank = SJ.stream_hot_items(d[0], p.get("size", "1 hour"), p.get("slide", "5 minutes"), p.get("n", 3))
        return {"report": (counts, lambda b: jobs.hot_items_report(rank(b)))}
    if job == "network_flow":
        counts, rank = SJ.stream_hot_urls(d[0], p.get("size", "10 minutes"), p.get("slide", "5 seconds"), p.get("n", 5))
        return {"report": (counts, lambda b: jobs.hot_urls_report(rank(b)))}
    if job == "blacklist_warning":
        return {"clicks": ST.stream_click_cap(d[0], **capped)}   # output = pass | warn; a second
        # stream over this table counts the passed clicks per province (see plans.stream_queries)
    if job == "login_fail":
        return {"warning": ST.stream_login_fail(d[0], within=p.get("within", "2 seconds"))}
    if job == "uv_with_bloom":
        return {"uv": ST.stream_running_unique_visitors(SJ.page_views(d[0]), p.get("size", "1 hour"))}
    if job == "app_marketing_by_channel":
        return {"count": SJ.unfold_windows(SJ.stream_marketing_stretches(d[0], ["channel", "behavior"], **sliding), **sliding)}
    if job == "app_marketing_statistics":
        return {"count": SJ.unfold_windows(SJ.stream_marketing_stretches(d[0], None, **sliding), **sliding)}
    if job == "page_view":
        return {"pv": SJ.stream_window_count(SJ.page_views(d[0]), None, p.get("size", "1 hour"))}
    if job == "unique_visitor":
        return {"uv": SJ.stream_unique_visitors(d[0], p.get("size", "1 hour"))}
    if job == "ad_statistics_by_geo":
        sizes = {"size": p.get("size", "1 hour"), "slide": p.get("slide", "5 seconds")}
        return {"count": SJ.unfold_windows(SJ.stream_sliding_stretches(d[0], "province", **sizes), **sizes)}
    if job == "login_fail_with_cep":
        return {"warning": ST.stream_strict_pair(d[0], within=p.get("within", "2 seconds"))}
    if job == "order_timeout":
        return {"result": ST.stream_followed_by_within(d[0], within=p.get("within", "15 minutes"))}
    if job == "order_timeout_without_cep":
        return {"result": ST.stream_order_outcomes(d[0], within=p.get("within", "15 minutes"))}
    raise SystemExit(f"no streaming form wired for {job}; run it without --stream")


def run(spark: SparkSession, job: str, inputs: list[str], output: str | None = None,
        stream: bool = False, params: dict | None = None) -> dict:
    """Run ``job``; returns {output name: DataFrame} (batch) or started queries (stream)."""
    kinds, fn = BATCH[job]
    if len(inputs) != len(kinds):
        raise SystemExit(f"{job} needs {len(kinds)} input(s): {', '.join(kinds)}")
    d = [_read(spark, k, path, stream, arrival=job == "login_fail") for k, path in zip(kinds, inputs)]
    params = dict(params or {})
    if isinstance(params.get("keys"), str):
        params["keys"] = tuple(k.strip() for k in params["keys"].split(","))
    if not stream:
        params.pop("max_ts_us", None)       # nothing is late in batch
    outs = _stream_outputs(job, d, params) if stream else fn(d, params)
    if stream:
        from streamlytics.session import scratch_path
        from streamlytics.streaming.core import state_settings
        qs = {}
        for name, df in outs.items():
            per_batch = None
            if isinstance(df, tuple):          # (stream, function applied to each micro-batch)
                df, per_batch = df
            w = df.writeStream.outputMode("append").option(
                "checkpointLocation", f"{output}/_checkpoints/{name}" if output else scratch_path(spark, name))
            if per_batch is not None:
                def sink(batch, epoch_id, fn=per_batch, name=name):
                    res = fn(batch)
                    if output:     # one folder per epoch: a retried epoch overwrites itself
                        res.write.mode("overwrite").parquet(f"{output}/{name}/epoch={epoch_id}")
                    else:
                        res.show(20, truncate=False)
                w = w.foreachBatch(sink)
            else:
                w = w.format("parquet").option("path", f"{output}/{name}") if output else w.format("console").option("truncate", False)
            with state_settings(spark):
                qs[name] = w.start()
        return qs
    if isinstance(outs, Tagged):
        if output:
            return outs.write(output)
        outs = outs.views()
    for name, df in outs.items():
        if output:
            df.write.mode("overwrite").parquet(f"{output}/{name}")
        else:
            print(f"== {name}")
            df.show(20, truncate=False)
    return outs


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=sorted(BATCH))
    ap.add_argument("--input", required=True)
    ap.add_argument("--input2")
    ap.add_argument("--output")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--param", action="append", default=[], help="key=value (e.g. slide=1 minute, n=5)")
    a = ap.parse_args(argv)
    params = {}
    for kv in a.param:
        k, v = kv.split("=", 1)
        params[k] = int(v) if v.isdigit() else v
    spark = SparkSession.builder.appName(f"streamlytics-{a.job}").getOrCreate()
    res = run(spark, a.job, [x for x in (a.input, a.input2) if x], a.output, a.stream, params)
    if a.stream:
        for q in res.values():
            q.awaitTermination()


if __name__ == "__main__":
    main()
