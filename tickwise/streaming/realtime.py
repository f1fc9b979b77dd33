"""Q3 + Q4 as Structured Streaming jobs.

``realtime_stream``: messages -> lenient parse (P1) -> drop invalid (F1) ->
count window with keyed state (W2) -> stream metrics (P4/P5) -> clean (P3).

``start_realtime_alerts``: the same stream, and per micro-batch
(``foreachBatch``, batch persisted once, two idempotent writes):

* metric rows -> ``stock`` (K2 first-wins append, ``insertflag`` = write time);
* rows joined to the historical ratio (J3) -> deviation (F2) -> threshold
  (F3) -> ``stock_alert`` (K2).

History lookup, two modes as in the source: *snapshot* (J3, the table is read
once when the job starts and frozen with a reliable checkpoint) or *fresh*
(J3b, the latest run of the history at the micro-batch's first attempt; the run
is noted beside the checkpoint, so a replay joins the same one).  Either way AQE broadcasts it only when its
measured size is small, else both sides are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions.columns import TOD_WIDTH
from ..operators.alerts import STOCK_COLS, alert_rows, hist_lookup_join, realtime_metrics
from ..operators.parse import drop_invalid, parse_tick_lenient
from ..sources.sinks import first_wins_append, pinned_run, read_or_none, read_run
from .batch_log import BatchLog
from .count_window import count_window_microbatch, count_window_stream


def parsed_ticks(messages: DataFrame) -> DataFrame:
    """P1 + F1 over ``(value, offset)`` messages; offset becomes ``tick_id``."""
    return drop_invalid(parse_tick_lenient(messages, keep=("offset",))).withColumnRenamed(
        "offset", "tick_id")


ARRIVAL = ("tick_id",)
#: For sources without positions (text lines): by time, then a tie-breaker.
BY_TIME = ("timestampvalue", "tick_id")


def realtime_stream(messages: DataFrame, n: int, rounded: bool = True, order=ARRIVAL) -> DataFrame:
    """Q3: one metric row per valid tick (append mode)."""
    return realtime_metrics(count_window_stream(parsed_ticks(messages), n, order=order), rounded)


def _start(writer, spark: SparkSession, trigger: dict | None,
           state_partitions: int | None = None) -> StreamingQuery:
    """Start ``writer`` (``availableNow`` unless a trigger is given).  A new
    query with keyed state gets ``state_partitions`` state store partitions
    (default: ``spark.sql.shuffle.partitions``); size it to the key count and
    state size: it cannot change later without a new checkpoint."""
    from ..session import keyed_state
    w = writer.trigger(**(trigger or {"availableNow": True}))
    with keyed_state(spark, state_partitions):
        return w.start()


def start_realtime_alerts(spark: SparkSession, messages: DataFrame, n: int, threshold: float,
                          stock_path: str, alert_path: str, checkpoint: str,
                          hist: DataFrame | None = None, hist_path: str | None = None,
                          width: int = TOD_WIDTH, rounded: bool = True,
                          trigger: dict | None = None,
                          state_path: str | None = None,
                          state_partitions: int | None = None, order=ARRIVAL,
                          stock_log: str | None = None,
                          between: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start Q3 + Q4 with the two sinks.  ``state_path`` given: the count
    window runs per micro-batch over a state table (skew-safe variant),
    otherwise in the keyed state store.  ``order``: of a key's ticks inside a
    micro-batch (state store only).  ``stock_log``: table of the rows and latest
    time appended to ``stock`` per micro-batch (``batch_log``).  ``between`` is
    called with the batch id after the first write and before the second; if it
    raises, the micro-batch fails there and is replayed on the next start."""
    if (hist is None) == (hist_path is None):
        raise ValueError("give the history as a DataFrame (snapshot) or a path (fresh)")
    snapshot = None
    if hist is not None:
        snapshot = hist.select("symbol", "timestampvalue", "histratio").checkpoint(eager=True)

    def history(batch_id: int) -> DataFrame:
        if snapshot is not None:
            return snapshot
        run = pinned_run(spark, hist_path, f"{checkpoint.rstrip('/')}/history_runs", batch_id)
        found = read_or_none(spark, hist_path) if run is None else read_run(spark, hist_path, run)
        return found.select("symbol", "timestampvalue", "histratio")

    def write(batch: DataFrame, batch_id: int) -> None:
        hist_now = history(batch_id)
        if state_path is not None:
            ticks = batch.persist()
            batch = realtime_metrics(count_window_microbatch(ticks, batch_id, state_path, n),
                                     rounded)
        batch.persist()
        try:
            stock = batch.select(*STOCK_COLS, "tick_id",
                                 F.current_timestamp().alias("insertflag"))
            first_wins_append(stock, stock_path, batch_id, S.STOCK,
                              log=None if stock_log is None else BatchLog(stock_log, batch_id))
            if between is not None:
                between(batch_id)
            alerts = alert_rows(hist_lookup_join(batch, hist_now, width), threshold, rounded)
            first_wins_append(alerts, alert_path, batch_id, S.ALERT)
        finally:
            batch.unpersist()
            if state_path is not None:
                ticks.unpersist()

    stream = realtime_stream(messages, n, rounded, order) if state_path is None else parsed_ticks(messages)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(w, spark, trigger, state_partitions)


def start_metrics_sink(stream: DataFrame, path: str, checkpoint: str,
                       trigger: dict | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """Append a streaming DataFrame to a parquet folder (exactly-once through
    the file sink's commit log)."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    return _start(w, stream.sparkSession, trigger, state_partitions)


def start_wide_store_sink(spark: SparkSession, metrics: DataFrame, path: str, checkpoint: str,
                          trigger: dict | None = None) -> StreamingQuery:
    """The wide-column-store feed (K3): each micro-batch appends its latest
    metrics per (symbol, time of day) as ``batch_id=<id>`` (a replay replaces
    them), so a micro-batch writes no more than it brings;
    :func:`read_wide_store` takes the latest row per key."""
    from ..operators.alerts import wide_store_rows
    from ..sources.sinks import write_batch
    w = metrics.writeStream.foreachBatch(
        lambda batch, batch_id: write_batch(wide_store_rows(batch), path, batch_id))
    return _start(w.option("checkpointLocation", checkpoint), spark, trigger)


def read_wide_store(spark: SparkSession, path: str) -> DataFrame:
    """The wide store's current rows: the last micro-batch's per key."""
    from ..operators.alerts import WIDE_STORE_COLS
    from ..sources.sinks import latest_per_key
    return latest_per_key(spark.read.parquet(path), WIDE_STORE_COLS[:2], ("batch_id",)).select(*WIDE_STORE_COLS)


def compact_wide_store(spark: SparkSession, path: str, new_path: str) -> str:
    """Rewrite the store at ``new_path`` with one row per key (``batch_id`` -1,
    so that later micro-batches still win)."""
    rows = read_wide_store(spark, path)
    rows.withColumn("batch_id", F.lit(-1)).write.partitionBy("batch_id").parquet(new_path)
    return new_path
