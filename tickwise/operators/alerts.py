"""Real-time metrics rows, historical lookup and alerts (Q3 batch replay, J3,
F2, F3, Q4, Q5).

The real-time path of the source system works tick by tick: a count window
of the last ``n`` ticks per symbol (W2), stream metrics (P4, rounded to 5
decimals in the store-writing variant: P5), then a lookup of the historical
ratio by (symbol, time of day) and an alert when the deviation of the current
ratio from it exceeds the threshold.  Here the same steps are column
expressions and joins over a tick DataFrame; the streaming jobs in
``tickwise.streaming`` apply them to each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (TOD_WIDTH, clean_quotes, deviation, round5, text_template,
                                 tod_of_raw)
from .metrics import metrics_stream, metrics_stream_rounded
from .windows import moving_avg_rows

TS = "timestampvalue"
STOCK_COLS = ("symbol", TS, "price", "volume", "priceavg", "pricechange", "volumeavg",
              "volumechange", "ratio")
ALERT_COLS = ("symbol", TS, "histratio", "currentratio", "ratiodeviation", "threshold")

# The alert texts of the source system (current and older form)
ALERT_TEXT = (" Alert has generated for stock {symbol} and timestamp {ts}. Historic Ratio : "
              "{hist}, Current Ratio : {current}, Ratio deviation : {deviation}, "
              "Threshold : {threshold}")
ALERT_TEXT_OLD = (" Alert has generated for stock {symbol} and timestamp {ts}. The historic ratio "
                  "for this stock is {hist} and ratio deviation {deviation}")


def realtime_metrics(windowed: DataFrame, rounded: bool = True, clean: bool = True) -> DataFrame:
    """P4/P5 + P3 over rows that carry ``priceavg``/``volumeavg``: the metric
    row as the stream computes it, symbol and time text with quotes removed
    (``clean=False``: kept, as the oldest stream variant stored them).
    Keeps ``tick_id`` (arrival order) when present."""
    m = (metrics_stream_rounded if rounded else metrics_stream)(
        windowed.withColumn("volume", F.col("volume").cast("double")))
    extra = [c for c in ("tick_id",) if c in windowed.columns]
    text = clean_quotes if clean else F.col
    return m.select(text("symbol").alias("symbol"), text(TS).alias(TS), *STOCK_COLS[2:], *extra)


def realtime_ratio(ticks: DataFrame, n: int, rounded: bool = True, clean: bool = True) -> DataFrame:
    """Q3 as a batch replay: count window over ticks ordered by (timestamp,
    ``tick_id``) + stream metrics.  Emits one row per tick."""
    w = moving_avg_rows(ticks, n, outputs=("priceavg", "volumeavg"))
    return realtime_metrics(w, rounded, clean)


def first_wins(df: DataFrame, keys=("symbol", TS), order: str = "tick_id") -> DataFrame:
    """K2: keep the first row (smallest ``order``, NULL last) per primary key,
    as a keyed store that rejects duplicate inserts does.  The whole row is one
    struct, so columns of different rows never mix, also where the order has
    ties or NULLs (then the smallest row by the other columns is kept)."""
    others = [c for c in df.columns if c not in keys and c != order]
    row = F.struct(F.col(order).isNull().alias("_last"), F.col(order).alias("_order"), *others)
    out = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return out.select(*[c if c in keys else F.col("_row._order" if c == order else f"_row.{c}").alias(c)
                        for c in df.columns])


def stock_rows(ticks: DataFrame, n: int, rounded: bool = True) -> DataFrame:
    """The ``stock`` table content: metric rows, first insert per (cleaned)
    key wins."""
    return first_wins(realtime_ratio(ticks, n, rounded)).select(*STOCK_COLS)


def hist_lookup_join(rows: DataFrame, hist: DataFrame, width: int = TOD_WIDTH,
                     ts_col: str = TS) -> DataFrame:
    """Attach ``histratio`` by symbol and time of day of the raw stream
    timestamp (an inner join: no history, no alert).  No broadcast hint: AQE
    broadcasts the history only when its measured size is small."""
    h = hist.select(F.col("symbol").alias("_hs"), F.col(TS).alias("_ht"), "histratio")
    keyed = rows.withColumn("_tod", tod_of_raw(ts_col, width))
    return (keyed.join(h, (keyed["symbol"] == h["_hs"]) & (keyed["_tod"] == h["_ht"]))
                 .drop("_hs", "_ht", "_tod"))


def alert_rows(joined: DataFrame, threshold: float, rounded: bool = True) -> DataFrame:
    """F2 + F3: deviation of the current ratio from history; rows with a finite
    deviation strictly above the threshold become alert rows.

    The source marked an unusable deviation with the value 99999.0 (so a real
    deviation of exactly 99999.0 was never alerted); here unusable is NULL."""
    dev = deviation("ratio", "histratio")
    r = round5 if rounded else (lambda c: F.col(c))
    extra = [c for c in ("tick_id",) if c in joined.columns]
    return (joined.withColumn("_dev", dev)
                  .where(F.col("_dev").isNotNull() & (F.col("_dev") > F.lit(float(threshold))))
                  .select("symbol", TS, r("histratio").alias("histratio"),
                          F.col("ratio").alias("currentratio"),
                          r("_dev").alias("ratiodeviation"),
                          F.lit(float(threshold)).alias("threshold"), *extra))


def ratio_alerts(ticks: DataFrame, hist: DataFrame, n: int, threshold: float,
                 width: int = TOD_WIDTH, rounded: bool = True) -> DataFrame:
    """Q4: the ``stock_alert`` rows produced by the live ticks."""
    rows = realtime_ratio(ticks, n, rounded)
    return first_wins(alert_rows(hist_lookup_join(rows, hist, width), threshold, rounded)).select(*ALERT_COLS)


def alert_messages(alerts: DataFrame, with_numbers: bool = True) -> DataFrame:
    """Q5: the alert text logged and mailed per alert.

    Numbers are printed with Spark's double-to-text cast, which follows the
    JVM's ``Double.toString`` as the source did.  ``with_numbers=False`` gives
    the older text that names only the ratio values."""
    text = text_template(ALERT_TEXT if with_numbers else ALERT_TEXT_OLD, symbol="symbol", ts=TS,
                         hist="histratio", current="currentratio",
                         deviation="ratiodeviation", threshold="threshold")
    return alerts.select("symbol", TS, text.alias("message"))


WIDE_STORE_COLS = ("symbol", TS, "avgprice", "avgvolume", "pricechange", "volumechange", "ratio",
                   "histratio")


def wide_store_rows(metrics: DataFrame) -> DataFrame:
    """The optional wide-column-store feed of the stream: one row per symbol
    and time of day (the full time text after the blank), the latest tick's
    metrics winning (K3, by ``tick_id``), with the current ratio stored as the
    historical ratio.  (The disabled source code bound avgvolume/pricechange
    to each other's values by position; columns are matched by name here.)"""
    rows = metrics.select(
        "symbol", F.try_element_at(F.split(TS, " "), F.lit(2)).alias(TS),
        F.col("priceavg").alias("avgprice"), F.col("volumeavg").alias("avgvolume"),
        "pricechange", "volumechange", "ratio", F.col("ratio").alias("histratio"), "tick_id")
    last = [F.max_by(c, F.col("tick_id")).alias(c) for c in WIDE_STORE_COLS[2:]]
    return rows.groupBy("symbol", TS).agg(*last)
