"""Sequence numbers for a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_path

#: ``monotonically_increasing_id``: the partition above these bits, the row's place below.
PLACE_BITS = 33


def with_sequence(df: DataFrame, *order, column: str = "seq", name: str = "sequence",
                  partitions: int | None = None) -> DataFrame:
    """``df`` with the number (from 0) of each row in the order given.

    Rows are range-partitioned and sorted inside the partitions; the numbers
    inside a partition are shifted by the sizes of the partitions before it (at
    most one small row per partition meets on the driver).  The sorted rows are
    written to the shared folder once, so a lost executor changes no number.
    ``order`` must be total where the numbers of equal rows matter; rows equal
    in it get different numbers in no stated order.  An empty table stays empty.
    """
    spark = df.sparkSession
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    path = new_path(spark, name)
    spread.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    schema = df.schema.add("_place", "long")
    rows = spark.read.schema(schema).parquet(path)
    part = F.shiftright("_place", PLACE_BITS)
    sizes = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    firsts, total = [], 0
    for k in sorted(sizes):
        firsts.append((k, total))
        total += sizes[k]
    first = spark.createDataFrame(firsts, "_part long, _first long")
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (rows.withColumn("_part", part).join(F.broadcast(first), "_part")
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_first") + place).alias(column)))
