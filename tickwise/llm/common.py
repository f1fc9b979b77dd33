"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, ship_package

# ASCII capitals and their small letters (the contracts lower-case only A-Z).
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows starts
    from files every executor can read, so a lost executor repeats no earlier
    stage and nothing is computed twice."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of tables that are no longer used:
    it does when the driver collects its garbage."""
    import gc
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, once the Python workers can import this package."""
    ship_package(df.sparkSession)
    return df


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def sized(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """``df`` with a broadcast hint when its counted rows are within
    ``max_rows``; larger, it is joined by shuffling both sides."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
