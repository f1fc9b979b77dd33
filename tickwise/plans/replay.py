"""Replay a table as a stream: stage its messages as ordered files in the
shared folder, run a streaming job over them with ``availableNow``, and read
back what the job wrote.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from ..session import new_path
from ..sources.streams import message_file_stream, stage_message_files

SLICES = 10          # micro-batches of a replay


def stage(spark: SparkSession, messages: DataFrame, name: str,
          slices: int = SLICES) -> DataFrame:
    """Write ``messages`` as ``slices`` ordered ranges; return the stream, one
    range per micro-batch."""
    src = new_path(spark, f"{name}-src")
    files = stage_message_files(messages, src, slices)
    return message_file_stream(spark, src, max_files_per_trigger=files)


def in_parts(parts, src: str, start) -> None:
    """Write each of ``parts`` (message tables) to ``src`` and run ``start(part
    number)``, a query over it, to its end: a micro-batch per part, with a
    restart from the checkpoint between them."""
    for i, part in enumerate(parts):
        part.write.mode("append").parquet(src)
        finish(start(i))


def finish(query) -> None:
    """Wait for a replay to end; raise what ended it early."""
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def expect_failure(query, text: str) -> None:
    """Wait for a query that is to fail with ``text``; raise if it does not."""
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if text not in str(e):
            raise
        return
    raise RuntimeError(f"the query did not fail with: {text}")


def state_partitions(spark: SparkSession) -> int:
    """State store partitions of a replay: one per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Append ``stream`` to a parquet folder until the input is exhausted."""
    from ..streaming.realtime import start_metrics_sink
    out, ckpt = new_path(spark, f"{name}-out"), new_path(spark, f"{name}-ckpt")
    q = start_metrics_sink(stream, out, ckpt, state_partitions=state_partitions(spark))
    finish(q)
    return spark.read.parquet(out)
