"""J1 over an index of what is transformed, instead of the transformed table.

A timestamp text of the usual forms (``yyyy-MM-dd HH:mm:ss`` and ``yyyy-MM-dd
HH:mm``, a valid date) is a number of seconds or minutes, one to one and in any
session time zone.  The index holds these numbers exactly, as bitmaps of 32 768
consecutive ones (``bitmap_construct_agg``); texts of any other form are kept
as they are.  Each run adds the bitmaps of its new rows, readers take the
union.  A run then scans the ticks once per kind of text and looks every tick
up in a bitmap: neither the ticks of the usual forms nor the transformed rows
are shuffled, and the index grows with time covered, 4 kB per nine hours of seconds,
not with rows.

Rows: (form, bucket, bitmap, text); ``form`` is the length of the usual form,
null for another text.  A null timestamp is never in the index, so such ticks
always belong to the delta, as in ``LEFT JOIN .. WHERE .. IS NULL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS = "timestampvalue"
INDEX = "form int, bucket long, bitmap binary, text string"
# The usual forms (whole seconds, whole minutes) by their length.
USUAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"
SECONDS = 19
BROADCAST_BITMAPS = 8192      # bitmaps sent to every task at most (32 MB); more are joined by shuffle


def form_of(ts: Column) -> Column:
    """Length of a text of a usual form with a valid date, else NULL."""
    day = F.substring(ts, 1, 10).try_cast("date")
    return F.when(ts.rlike(USUAL) & day.isNotNull(), F.length(ts))


def number_of(ts: Column) -> Column:
    """Seconds or minutes since 1970-01-01 of a text of a usual form."""
    part = lambda at: F.substring(ts, at, 2).try_cast("long")
    minutes = F.unix_date(F.substring(ts, 1, 10).try_cast("date")).cast("long") * 1440 + part(12) * 60 + part(15)
    return F.when(F.length(ts) == SECONDS, minutes * 60 + part(18)).otherwise(minutes)


def index_rows(done: DataFrame, ts: str = TS) -> DataFrame:
    """Index rows of transformed rows (partial bitmaps per task, then one per
    bucket)."""
    t = done.select(F.col(ts).alias("text")).where(F.col("text").isNotNull()).select(
        "text", form_of(F.col("text")).alias("form"))
    numbers = t.where(F.col("form").isNotNull()).select("form", number_of(F.col("text")).alias("n"))
    bitmaps = (numbers.groupBy("form", F.bitmap_bucket_number("n").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap")))
    other = t.where(F.col("form").isNull()).select("text").distinct()
    return bitmaps.withColumn("text", F.lit(None).cast("string")).unionByName(other, allowMissingColumns=True)


def read_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of the index rows the runs have written."""
    rows = spark.read.schema(INDEX).parquet(*paths) if paths else spark.createDataFrame([], INDEX)
    return rows.groupBy("form", "bucket", "text").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _holds(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def delta_by_index(ticks: DataFrame, index: DataFrame, ts: str = TS) -> DataFrame:
    """The ticks whose timestamp text is not in the index (a stored table
    or :func:`read_index`)."""
    columns = [F.col(f"`{c}`") for c in ticks.columns]
    usual = index.where(F.col("form").isNotNull()).select(
        F.col("form").alias("_form"), F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    few = usual.limit(BROADCAST_BITMAPS + 1).count() <= BROADCAST_BITMAPS
    number = number_of(F.col(ts))
    # the null-safe CASE keeps the number of other texts from being computed
    placed = ticks.withColumn("_form", form_of(F.col(ts)))
    formed = placed.where(F.col("_form").isNotNull()).withColumn("_bucket", F.bitmap_bucket_number(number))
    met = formed.join(F.broadcast(usual) if few else usual, ["_form", "_bucket"], "left")
    new = met.where(F.col("_bitmap").isNull() | ~_holds(F.col("_bitmap"), F.bitmap_bit_position(number)))
    texts = index.where(F.col("text").isNotNull()).select(F.col("text").alias("_text"))
    rest = placed.where(F.col("_form").isNull())
    rest = rest.join(texts, F.col(ts) == F.col("_text"), "left_anti")
    return new.select(*columns).unionByName(rest.select(*columns))
