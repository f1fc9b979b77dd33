"""K1: incremental dashboard and mail feeds as streams over the tables.

The source polled with an in-memory high-water mark (lost on restart, so
everything was re-sent).  Here each feed is a checkpointed ``readStream`` of
the table folder: every micro-batch holds only the rows written since the
last one, and a restart resumes where the checkpoint left off.  Delivery goes
through a caller-supplied ``writer(payload: str)`` called from the tasks, in
no order between tasks (the rows carry their time).
Instead of a writer, ``deliver(rows, batch_id)`` may take a micro-batch's rows
as a DataFrame (e.g. to append them to a table).
Each ``start_*`` runs once over what is new (``availableNow``) unless a
trigger is given, e.g. ``POLL_TRIGGERS["dashboard"]`` for a continuous feed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import feeds as FD
from ..sources.sinks import batch_bounds, keyed_schema, read_dates, rows_in_bounds
from ..sources.streams import table_stream


# Poll intervals of the source system's feeds, as triggers.
POLL_TRIGGERS = {
    "dashboard": {"processingTime": "5 seconds"},
    "alert_counts": {"processingTime": "5 seconds"},
    "alert_pivot": {"processingTime": "1 second"},
    "alert_feed": {"processingTime": "100 seconds"},
    "alert_digest": {"processingTime": "1 second"},
}


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


Deliver = Callable[[DataFrame, int], None]


def start_dashboard_feed(spark: SparkSession, stock_path: str, alert_path: str, checkpoint: str,
                         writer: Callable[[str], None] | None = None, trigger: dict | None = None,
                         deliver: Deliver | None = None) -> StreamingQuery:
    """Q6 continuously: new stock rows, left-joined to the alerts written so
    far (only alert rows in the batch's dates and time range are read)."""
    def send(batch: DataFrame, batch_id: int) -> None:
        bounds = batch_bounds(batch)
        alerts = rows_in_bounds(read_dates(spark, alert_path, keyed_schema(S.ALERT), bounds[0]), bounds)
        feed = FD.dashboard_feed(batch, alerts, None, ordered=False)
        rows = FD.json_rows(feed, FD.DASHBOARD_COLUMNS)
        deliver(rows, batch_id) if deliver else FD.post_json_payloads(rows, writer)
    return _start(table_stream(spark, stock_path, keyed_schema(S.STOCK)), send, checkpoint, trigger)


def start_alert_feed(spark: SparkSession, alert_path: str, checkpoint: str,
                     writer: Callable[[str], None], trigger: dict | None = None) -> StreamingQuery:
    """Q7 continuously: new alert rows with ``Alert = 1``."""
    def send(batch: DataFrame, batch_id: int) -> None:
        FD.post_json_payloads(FD.json_rows(FD.alert_feed(batch, None, ordered=False), FD.ALERT_FEED_COLUMNS),
                              writer)
    return _start(table_stream(spark, alert_path, keyed_schema(S.ALERT)), send, checkpoint, trigger)


def start_alert_digest(spark: SparkSession, alert_path: str, checkpoint: str,
                       writer: Callable[[str], None] | None = None, trigger: dict | None = None,
                       deliver: Deliver | None = None) -> StreamingQuery:
    """Q10 continuously: one (subject, body) text per new alert, handed to
    ``writer`` as ``subject + "\\n" + body`` (mail delivery is the writer's)."""
    def send(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            digest = FD.alert_digest(batch, None, ordered=False)
            if deliver:
                deliver(digest, batch_id)
                return
            digest.select(F.concat_ws("\n", "subject", "body")).foreachPartition(
                lambda rows: [writer(r[0]) for r in rows])
        finally:
            batch.unpersist()
    return _start(table_stream(spark, alert_path, keyed_schema(S.ALERT)), send, checkpoint, trigger)


def alert_count_stream(spark: SparkSession, alert_path: str) -> DataFrame:
    """Q8 as a streaming aggregation (complete mode): the running alert count
    per symbol, kept in the state store with partial aggregation per task."""
    return FD.alert_counts(table_stream(spark, alert_path, keyed_schema(S.ALERT)))


def start_count_feeds(spark: SparkSession, alert_path: str, checkpoint: str,
                      writer: Callable[[str], None], symbols: Sequence[str] | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Q8 (``symbols=None``) or Q9 (pivot over ``symbols`` + TOTAL) after every
    micro-batch, from the running counts; counts are quoted in the payload."""
    counts = alert_count_stream(spark, alert_path)

    def send(batch: DataFrame, batch_id: int) -> None:
        if symbols is None:
            payload = FD.count_payload_rows(batch)
        else:
            counts = batch.select("symbol", F.col("count").alias("alerts"))
            payload = FD.count_payload_rows(FD.pivot_counts(counts, symbols))
        FD.post_json_payloads(payload, writer)

    w = (counts.writeStream.outputMode("complete").foreachBatch(send)
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()
