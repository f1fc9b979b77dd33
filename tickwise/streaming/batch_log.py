"""What each micro-batch wrote, as a table: its number of rows (A6) and its
latest time (the part of A8 that is the micro-batch's).

The numbers are observed metrics of the write itself (no second job over the
rows, no scan of the table written) and land in the log's ``batch_id=<id>``
folder, so a replayed micro-batch replaces its row.  The high-water mark of the
table is the maximum of the log, which holds one short row per micro-batch,
instead of a maximum over all rows at every poll; unlike a mark in memory it is
there after a restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.feeds import high_watermark
from ..sources.sinks import read_or_none, write_batch

TS = "timestampvalue"
LOG_SCHEMA = T.StructType([T.StructField("rows", T.LongType()), T.StructField("mark", T.StringType()),
                           T.StructField("batch_id", T.IntegerType())])


class BatchLog:
    """Observe the rows of one micro-batch's write, then store the result.

    ``rows = log.observed(rows)``, write ``rows``, ``log.store()``.  An empty
    micro-batch is logged with 0 rows and no mark."""

    def __init__(self, path: str, batch_id: int, ts: str = TS):
        self.path, self.batch_id, self.ts = path, int(batch_id), ts
        self.observation = Observation(f"batch_{self.batch_id}")
        self.spark: SparkSession | None = None

    def observed(self, rows: DataFrame) -> DataFrame:
        self.spark = rows.sparkSession
        return rows.observe(self.observation, F.count(F.lit(1)).alias("rows"), F.max(self.ts).alias("mark"))

    def store(self) -> int:
        """Write the log's row; returns the number of rows observed."""
        seen = self.observation.get
        one = self.spark.range(0, 1, 1, 1).select(F.lit(int(seen["rows"])).cast("long").alias("rows"),
                                                  F.lit(seen["mark"]).cast("string").alias("mark"))
        write_batch(one, self.path, self.batch_id)
        return int(seen["rows"])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, rows, mark)`` per micro-batch; empty before the first."""
    found = read_or_none(spark, path, LOG_SCHEMA)
    return (spark.createDataFrame([], LOG_SCHEMA) if found is None else found).select("batch_id", "rows", "mark")


def logged_watermark(spark: SparkSession, path: str) -> DataFrame:
    """A8 from the log: one row, NULL before the first micro-batch."""
    return high_watermark(read_log(spark, path), "mark")
