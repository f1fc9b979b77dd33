"""Stream sources of tick messages.

The core streaming jobs take any streaming DataFrame with a ``value`` text
column (and an ``offset`` used as the arrival-order tie-breaker).  Production
uses Kafka (``connectors.kafka_stream``); tests and the bench replay files
with ``availableNow``.  A micro-batch takes all that is new unless the caller
bounds it (``max_files_per_trigger``); no result depends on that bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("offset", T.LongType()),
])

TOPIC_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


def _files(spark: SparkSession, fmt: str, max_files_per_trigger: int | None):
    reader = spark.readStream.format(fmt)
    return reader if max_files_per_trigger is None else reader.option("maxFilesPerTrigger", max_files_per_trigger)


def message_file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None,
                        schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Streaming ``(value, offset)`` (or the columns of ``schema``) from message
    files (parquet or JSON lines) dropped into ``path``; oldest files first."""
    return _files(spark, fmt, max_files_per_trigger).schema(schema).load(path)


def text_line_stream(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw text lines (one JSON tick per line) as ``value``.  Text files carry
    no line positions, so windows over them are ordered by time
    (``realtime.BY_TIME``), and the tie-breaker of ticks sharing a timestamp is a
    hash of the line: deterministic on replay, and identical lines are
    identical ticks, so their relative order cannot change any result."""
    return _files(spark, "text", max_files_per_trigger).load(path).select("value", F.xxhash64("value").alias("offset"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table read incrementally (new files only), for the feeds."""
    return _files(spark, "parquet", max_files_per_trigger).schema(schema).load(path)


FILE_ROWS = 500_000       # messages of a staged file, about


def stage_message_files(messages: DataFrame, path: str, slices: int,
                        order_col: str = "offset", files_per_slice: int | None = None) -> int:
    """Write messages as ``slices`` consecutive ranges of ``order_col`` with
    about equally many rows, one write per range in order, so a file stream
    delivers them in that order; returns the number of files of a range
    (``maxFilesPerTrigger`` of that many: one range per micro-batch).

    Used to replay a table as a stream in tests and the bench.  The messages
    are computed once, into a folder per range; each range is then copied by
    as many tasks as its rows ask for.
    """
    from ..session import new_path
    spark = messages.sparkSession
    at = [(i + 1) / slices for i in range(slices - 1)]
    ends = messages.agg(F.percentile_approx(order_col, at, 10_000).alias("e")).first()["e"] if at else []
    ends = ends or []
    slice_of = F.lit(0)
    for e in ends:
        slice_of = slice_of + F.when(F.col(order_col) > e, 1).otherwise(0)
    staged = new_path(spark, "staged")
    messages.withColumn("_slice", slice_of).write.partitionBy("_slice").parquet(staged)
    parts = spark.read.schema(T.StructType([*messages.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(staged)
    if files_per_slice is None:
        files_per_slice = max(1, -(-parts.count() // (slices * FILE_ROWS)))
    for i in range(slices):
        part = parts.where(F.col("_slice") == i).drop("_slice")
        part.repartition(files_per_slice).write.mode("append").parquet(path)
    return files_per_slice
