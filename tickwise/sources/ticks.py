"""Tick tables derived from the given parquet tables.

A tick is ``(symbol, timestampvalue, price, volume)`` plus ``tick_id``, a
unique tie-breaker that fixes the order of ticks sharing a timestamp (the
source system ordered by timestamp text only, which is nondeterministic on
ties).  Only projections are used here, so Catalyst prunes the scans to the
listed columns and pushes any later filter on them into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Timestamp text formats of the source system.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


# Java date patterns of the two tick text formats and their lengths
_FORMAT_CHARS = {TS_FORMAT: 19, MINUTE_FORMAT: 16}


def ts_text(df: DataFrame, col: str, fmt: str = TS_FORMAT):
    """Timestamp text of ``col``.  A TIMESTAMP_NTZ value cast to string is
    ``yyyy-MM-dd HH:mm:ss[.ffffff]`` with no time-zone conversion, so its
    prefix is the text, whatever the session time zone (``date_format`` would
    convert through the session zone and shift times inside DST gaps)."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[col].dataType, TimestampNTZType) and fmt in _FORMAT_CHARS:
        return F.substring(F.col(col).cast("string"), 1, _FORMAT_CHARS[fmt])
    return F.date_format(col, fmt)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks_from_events(events: DataFrame, ts_format: str = TS_FORMAT,
                      symbol_col: str = "event_type") -> DataFrame:
    """``events`` as ticks: symbol = event type, time text from ``ts``,
    price = ``value``, volume = integer ``props.k``, tie-breaker = ``event_id``."""
    return events.select(
        F.col(symbol_col).cast("string").alias("symbol"),
        ts_text(events, "ts", ts_format).alias("timestampvalue"),
        F.col("value").cast("double").alias("price"),
        F.get_json_object("props", "$.k").try_cast("int").alias("volume"),
        F.col("event_id").alias("tick_id"),
    )


def ticks_from_events_by_user(events: DataFrame, ts_format: str = TS_FORMAT) -> DataFrame:
    """``events`` as ticks with one symbol per user (``U<user_id>``): many
    sparse symbols instead of five dense ones."""
    return ticks_from_events(events.withColumn("event_type", F.concat(F.lit("U"), "user_id")),
                             ts_format)


def ticks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as a larger tick table with many symbols (part keys) and
    day-resolution timestamps; ties are broken by (orderkey, linenumber)."""
    return lineitem.select(
        F.col("l_partkey").cast("string").alias("symbol"),
        ts_text(lineitem, "l_shipdate").alias("timestampvalue"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("volume"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("tick_id"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def tick_messages(ticks: DataFrame) -> DataFrame:
    """Ticks as the JSON text messages the stream source delivers
    (``value`` column, as a Kafka value cast to string), with the tie-breaker
    kept alongside as the message offset."""
    from ..functions.columns import tick_json
    return ticks.select(tick_json(ts="timestampvalue").alias("value"),
                        F.col("tick_id").alias("offset"))
