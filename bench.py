"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query to completion through the ``noop`` sink (full computation, no
driver collect): one untimed warm-up run at the bench scale, then the median of
``BENCH_REPS`` (default 3) timed runs.  Streaming queries replay the staged
ticks from a fresh checkpoint on every run.  Prints ONE JSON line:
``{"metric", "value" (total seconds), "unit", "queries" {name: sec}, "sf",
"rows" {name: input ticks}, "rows_per_sec" {name: ticks/s}}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from tickwise.operators.alerts import ratio_alerts  # noqa: E402
from tickwise.operators.history import hist_ratio_query, ratio_query  # noqa: E402
from tickwise.plans import fixtures as X  # noqa: E402
from tickwise.session import get_session, new_path  # noqa: E402
from tickwise.sources.streams import message_file_stream, stage_message_files  # noqa: E402
from tickwise.sources.ticks import tick_messages  # noqa: E402
from tickwise.operators.alerts import realtime_metrics  # noqa: E402
from tickwise.streaming.count_window import count_window_microbatch  # noqa: E402
from tickwise.streaming.realtime import parsed_ticks, realtime_stream  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def batch_queries(spark, d):
    # every query is built inside the timer, with the jobs it runs while being built
    return {
        "ratio_query": lambda: ratio_query(X.minute_ticks(spark, d), X.done_minute(spark, d),
                                           X.WINDOW),
        "hist_ratio_query": lambda: hist_ratio_query(ratio_query(X.ticks(spark, d), None, X.WINDOW),
                                                     X.TOD_WIDTH_TEST),
        "ratio_alerts": lambda: ratio_alerts(X.live_ticks(spark, d), X.history(spark, d),
                                             X.WINDOW, X.THRESHOLD, width=X.TOD_WIDTH_TEST),
        "ratio_query_lineitem": lambda: ratio_query(
            __import__("tickwise.sources.ticks", fromlist=["x"]).lineitem_ticks(spark, d),
            None, X.WINDOW),
    }


def stream_query(spark, d, slices: int, state_table: bool = False):
    """Stage the ticks as ``slices`` ordered file ranges (not timed) and return
    a callable running the realtime stream over them to completion: the count
    window in the keyed state store, or (``state_table``) per micro-batch over
    a state table with hot-key splitting."""
    src = new_path(spark, f"bench-src-{slices}")
    msgs = tick_messages(X.ticks(spark, d))
    files = stage_message_files(msgs, src, slices)

    def run():
        messages = message_file_stream(spark, src, max_files_per_trigger=files)
        ckpt = new_path(spark, f"bench-ckpt-{slices}")
        if state_table:
            state = new_path(spark, f"bench-state-{slices}")

            def write(batch, batch_id):
                w = count_window_microbatch(batch, batch_id, state, X.WINDOW)
                noop(realtime_metrics(w))
            q = (parsed_ticks(messages).writeStream.foreachBatch(write)
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        else:
            stream = realtime_stream(messages, X.WINDOW)
            q = (stream.writeStream.format("noop").outputMode("append")
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return run


def timed(fn, reps: int) -> float:
    fn()                                   # warm-up at the bench scale
    runs = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return sorted(runs)[len(runs) // 2]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    # one shuffle partition per core locally; AQE coalesces small ones
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    m = re.search(r"sf([0-9.]+)", d)
    sf = float(m.group(1)) if m else None

    times, rows = {}, {}
    n_events = spark.read.parquet(f"{d}/events.parquet").count()
    n_items = spark.read.parquet(f"{d}/lineitem.parquet").count()
    for name, f in batch_queries(spark, d).items():
        times[name] = round(timed(lambda: noop(f()), reps), 3)
        rows[name] = n_items if name.endswith("lineitem") else n_events
    for slices, state_table in ((1, False), (10, False), (10, True)):
        run = stream_query(spark, d, slices, state_table)
        name = f"count_window_stream_{'split_' if state_table else ''}{slices}mb"
        times[name] = round(timed(run, reps), 3)
        rows[name] = n_events
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "rows": rows,
        "rows_per_sec": {k: round(rows[k] / v) if v else None for k, v in times.items()},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
