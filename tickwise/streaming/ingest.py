"""Micro-batch ingest of raw ticks (the 60-second batch load of
``stock_tracker``).

Each micro-batch is parsed strictly (P2: a bad record fails the batch, which
is retried from the checkpoint), skipped when empty, written idempotently
into its own ``batch_id`` partition and counted with an observed metric
(A6) instead of a second job.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import parse_tick_strict
from ..sources.sinks import write_batch, write_batch_to_table
from .batch_log import BatchLog

log = logging.getLogger(__name__)

INGEST_INTERVAL = "60 seconds"


def load_batch(batch: DataFrame, batch_id: int, target: str, table: bool = False,
               log_path: str | None = None) -> int:
    """Parse and append one micro-batch to a parquet folder or (``table``) a
    catalog table partitioned by ``batch_id``; returns the number of rows.
    ``log_path``: rows and latest time of the batch go to that table
    (``batch_log``); an empty batch is not logged."""
    if batch.isEmpty():
        return 0
    keep = ("offset",) if "offset" in batch.columns else ()
    ticks = parse_tick_strict(batch, keep=keep)
    if keep:
        # the message offset is the tie-breaker of ticks sharing a timestamp
        ticks = ticks.withColumnRenamed("offset", "tick_id")
    if log_path is not None:
        batch_log = BatchLog(log_path, batch_id)
        ticks = batch_log.observed(ticks)
    else:
        obs = Observation(f"ingest_{batch_id}")
        ticks = ticks.observe(obs, F.count(F.lit(1)).alias("rows"))
    if table:
        write_batch_to_table(ticks, target, batch_id)
    else:
        write_batch(ticks, target, batch_id)
    n = int(obs.get["rows"]) if log_path is None else batch_log.store()
    log.info("batch %s: %s ticks appended to %s", batch_id, n, target)
    return n


def start_ingest(messages: DataFrame, target: str, checkpoint: str,
                 trigger: dict | None = None, table: bool = False,
                 log_path: str | None = None) -> StreamingQuery:
    """``messages`` (streaming, ``value`` text) -> raw tick table at
    ``target`` (a folder, or a catalog table name with ``table=True``, e.g.
    the bucketed table of ``plans.jobs.create_bucketed_tables``); every
    ``INGEST_INTERVAL`` by default."""
    w = (messages.writeStream
         .foreachBatch(lambda b, i: load_batch(b, i, target, table, log_path))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": INGEST_INTERVAL})).start()
