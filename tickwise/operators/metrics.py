"""Price/volume change and their ratio.

The batch job (SQL) and the streaming job (JVM doubles) compute the same
formulas with different zero-divisor rules; both are kept:

* :func:`metrics_batch` (P6): zero divisor -> NULL, ``ratio = NVL(pc/vc, 0)``,
  price/volume change stay NULL;
* :func:`metrics_stream` (P4): IEEE division; ``ratio = pc/vc`` from the raw
  changes, then NaN -> 0 in ratio, pricechange and volumechange; +-Infinity is
  kept (x/0 with x != 0);
* :func:`metrics_stream_rounded` (P5): P4 with all seven numbers rounded
  half-up to 5 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ieee_divide, nan_to_zero, pct_change_sql, ratio_sql, round5


def metrics_batch(df: DataFrame, price="price", volume="volume",
                  avgprice="avgprice", avgvolume="avgvolume") -> DataFrame:
    pc = pct_change_sql(price, avgprice)
    vc = pct_change_sql(volume, avgvolume)
    return (df.withColumn("pricechange", pc)
              .withColumn("volumechange", vc)
              .withColumn("ratio", ratio_sql("pricechange", "volumechange")))


def metrics_stream(df: DataFrame, price="price", volume="volume",
                   avgprice="priceavg", avgvolume="volumeavg") -> DataFrame:
    pc = ieee_divide((F.col(price) - F.col(avgprice)) * F.lit(100.0), F.col(avgprice))
    vc = ieee_divide((F.col(volume) - F.col(avgvolume)) * F.lit(100.0), F.col(avgvolume))
    return (df.withColumn("_pc", pc).withColumn("_vc", vc)
              .withColumn("ratio", nan_to_zero(ieee_divide("_pc", "_vc")))
              .withColumn("pricechange", nan_to_zero("_pc"))
              .withColumn("volumechange", nan_to_zero("_vc"))
              .drop("_pc", "_vc"))


STREAM_NUMBERS = ("price", "volume", "priceavg", "pricechange", "volumeavg", "volumechange", "ratio")


def metrics_stream_rounded(df: DataFrame, **kw) -> DataFrame:
    out = metrics_stream(df, **kw)
    return out.select(*[round5(c).alias(c) if c in STREAM_NUMBERS else F.col(c)
                        for c in out.columns])
