"""Sliding count window (size n, slide 1) per key over a stream.

Structured Streaming has no count window, so it is a keyed stateful operator
(``transformWithStateInPandas``, see ``keyed_window``): the state of a key is
its last ``n-1`` prices and volumes (O(n) per key, independent of the data
size).  Each micro-batch brings a key's new ticks; they are put in arrival
order and every tick emits ``(last ts, last price, last volume, mean price,
mean volume)`` over the last ``min(n, seen)`` ticks, as the source's count
window did.

Arrival order: a shuffle does not keep it, so inside a micro-batch the ticks
of a key are ordered by the message offset (``tick_id``) alone; across
micro-batches the batch order is the arrival order.  The result therefore does
not depend on where the micro-batches are cut, whatever the ticks' timestamps.

Group size: a key's rows are taken as an iterator and put in order a range at a
time, so one key may hold a whole micro-batch.  Its windows are still computed
by one task; where that is too slow, :func:`count_window_microbatch` splits hot
keys into offset ranges like the batch window, with a state table instead of
the state store.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keyed_window import window_means  # noqa: F401  (part of this module's interface)

# frames with all-NA columns are concatenated; recent pandas warns about that
# on every group.  Silence that one message.
warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation with empty",
                        category=FutureWarning)


def count_window_stream(ticks: DataFrame, n: int, key: str = "symbol",
                        order: Sequence[str] = ("tick_id",), held_rows: int | None = None) -> DataFrame:
    """Streaming DataFrame of ticks -> ticks with ``priceavg`` and
    ``volumeavg`` over the key's last ``n`` ticks.  Output mode: append.  Start
    it with the RocksDB state store (``session.DEFAULT_CONF``, or
    ``session.keyed_state`` around ``start()``).  ``held_rows``: rows of a key
    put in order in memory at a time (no effect on results)."""
    from ..session import ship_package
    from pyspark import cloudpickle
    from . import keyed_window
    if n < 1:
        raise ValueError("window size must be >= 1")
    ship_package(ticks.sparkSession)
    # the processor is also started beside the driver, where shipped files are not on the path
    cloudpickle.register_pickle_by_value(keyed_window)
    cols = [key, *[c for c in ("timestampvalue", "tick_id") if c in ticks.columns and c != key]]
    src = ticks.select(*cols, "price", "volume")
    fields = {f.name: f for f in src.schema.fields}
    out_schema = T.StructType([fields[c] for c in cols] + [
        T.StructField("price", T.DoubleType()), T.StructField("volume", T.DoubleType()),
        T.StructField("priceavg", T.DoubleType()), T.StructField("volumeavg", T.DoubleType())])
    processor = keyed_window.CountWindow(n, [c for c in order if c in cols], held_rows or keyed_window.HELD_ROWS)
    return src.groupBy(key).transformWithStateInPandas(
        processor, outputStructType=out_schema, outputMode="Append", timeMode="None")


# ---- skew-safe variant: count window per micro-batch with a state table ------------

BATCH = "_tw_batch"
_CTX = "_tw_ctx"
STATE_COLS = ("timestampvalue", "tick_id", "price", "volume", BATCH)


def _latest_state(spark, state_path: str, batch_id: int, key: str, key_type) -> DataFrame:
    from ..sources.sinks import version_before
    fields = [T.StructField(key, key_type), T.StructField("timestampvalue", T.StringType()),
              T.StructField("tick_id", T.LongType()), T.StructField("price", T.DoubleType()),
              T.StructField("volume", T.DoubleType()), T.StructField(BATCH, T.LongType())]
    return version_before(spark, state_path, batch_id, T.StructType(fields))


def count_window_microbatch(batch: DataFrame, batch_id: int, state_path: str, n: int,
                            key: str = "symbol") -> DataFrame:
    """W2 for one micro-batch without a per-key task: the batch's ticks are
    put after the key's last ``n-1`` ticks of earlier batches (the state
    table version written by the previous batch), ordered by (batch id, tick
    id) = arrival order, and run through the hot-key-splitting row window.  The new state version ``run=<batch_id>`` (last ``n-1`` ticks
    per key, a partial top-k before its shuffle) is written before returning;
    a replayed batch reads the version before it and rewrites its own; versions
    no replay can need any more are deleted."""
    from ..operators.windows import moving_avg_rows
    from ..sources.sinks import RUN, drop_runs_before
    spark = batch.sparkSession
    rows = batch.select(key, "timestampvalue", "tick_id", F.col("price").cast("double").alias("price"),
                        F.col("volume").cast("double").alias("volume"),
                        F.lit(int(batch_id)).cast("long").alias(BATCH))
    prev = _latest_state(spark, state_path, batch_id, key, batch.schema[key].dataType)
    both = prev.withColumn(_CTX, F.lit(True)).unionByName(rows.withColumn(_CTX, F.lit(False)))
    order = (BATCH, "tick_id")

    w_last = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    state = (both.withColumn("_rd", F.row_number().over(w_last)).where(F.col("_rd") <= max(n - 1, 0))
                 .select(key, *STATE_COLS))
    state.write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/{RUN}={int(batch_id)}")
    drop_runs_before(spark, state_path, int(batch_id) - 1)      # the last batch may still be replayed

    # the window only needs the state of keys present in this batch
    present = rows.select(F.col(key).alias("_tw_present")).distinct()
    context = prev.join(present, F.col(key).eqNullSafe(F.col("_tw_present")), "left_semi")
    window_in = context.withColumn(_CTX, F.lit(True)).unionByName(rows.withColumn(_CTX, F.lit(False)))
    out = moving_avg_rows(window_in, n, key, order=order, outputs=("priceavg", "volumeavg"))
    return out.where(~F.col(_CTX)).drop(_CTX, BATCH)


def start_count_window_batches(ticks: DataFrame, n: int, out_path: str, state_path: str,
                               checkpoint: str, trigger: dict | None = None):
    """Streaming W2 through ``foreachBatch`` + :func:`count_window_microbatch`;
    output rows land in ``batch_id=<id>`` partitions (idempotent)."""
    from ..sources.sinks import write_batch

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(count_window_microbatch(batch, batch_id, state_path, n), out_path, batch_id)
        finally:
            batch.unpersist()

    w = ticks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
