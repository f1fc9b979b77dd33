"""Kafka and JDBC connections, as Spark reader options.

The connector jars are not part of this build, so these functions build the
reader with its options and leave the format to the cluster's classpath; the
option dictionaries are what tests check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import arrival_position


def kafka_options(servers: str, topics: str | list[str], starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """Options of a Kafka tick source.  ``earliest`` as the ingest job used;
    the checkpoint replaces consumer-group auto commit.  Lost offsets fail the
    query (Spark's default), and a micro-batch takes all that is new unless
    ``max_offsets_per_trigger`` is given."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, servers: str, topics, **kw) -> DataFrame:
    """Streaming ``(value, offset)`` from Kafka: the message value as text and
    the partition offset (arrival order within a partition; a symbol's ticks
    share a partition when the producer keys by symbol).  Offsets of several
    topics clash, so with more than one topic ``offset`` is the text of
    :func:`~tickwise.functions.columns.arrival_position`, which orders windows and first-wins rows alike."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topics, **kw).items():
        reader = reader.option(k, v)
    several = "," in topics if isinstance(topics, str) else len(topics) > 1
    return with_positions(reader.load()) if several else reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("offset").cast("long").alias("offset"))


def with_positions(messages: DataFrame) -> DataFrame:
    """``(value, topic, partition, offset)`` messages -> ``(value, offset)``
    with the arrival position as ``offset``."""
    return messages.select(F.col("value").cast("string").alias("value"), arrival_position().alias("offset"))


def jdbc_query_options(url: str, query: str | None = None, table: str | None = None,
                       partition_column: str | None = None, lower: int | None = None,
                       upper: int | None = None, num_partitions: int | None = None,
                       fetch_size: int = 10_000, extra: dict | None = None) -> dict[str, str]:
    """Options of a JDBC read.  A query input runs on one connection; for a
    large table give a numeric ``partition_column`` with bounds so Spark splits
    the read into ``num_partitions`` range queries."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if query is not None:
        if partition_column:
            raise ValueError("partitioned reads need a table (or a subquery as table)")
        opts["query"] = query
    else:
        opts["dbtable"] = table
        if partition_column:
            if lower is None or upper is None or not num_partitions:
                raise ValueError("partitioned reads need lower, upper and num_partitions")
            opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                         "upperBound": str(upper), "numPartitions": str(num_partitions)})
    opts.update(extra or {})
    return opts


def jdbc_read(spark: SparkSession, **kw) -> DataFrame:
    reader = spark.read.format("jdbc")
    for k, v in jdbc_query_options(**kw).items():
        reader = reader.option(k, v)
    return reader.load()
