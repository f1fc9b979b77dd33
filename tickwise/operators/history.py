"""Batch ratio job and historical ratio per time of day.

``ratio_query`` (Q1) = delta anti join (J1) -> row window (W1) -> batch
metrics (P6).  ``hist_ratio_query`` (Q2) = per-(symbol, time-of-day) average
ratio (A1) joined (J2) to the rows whose timestamp is the latest of *some*
group (A2 + J4, an uncorrelated IN), rounded to 5 decimals (``rounded=True``,
the key-value-store variant) or not.  ``hist_ratio_strict`` is the one-row-per
-key form used as the alert lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import TOD_WIDTH, round5, tod
from .metrics import metrics_batch
from .windows import moving_avg_rows

TS = "timestampvalue"
TRANSFORMED_COLS = ("symbol", TS, "avgprice", "pricechange", "avgvol", "volumechange", "ratio")
HISTORY_COLS = ("symbol", TS, "avgprice", "pricechange", "avgvolume", "volumechange", "ratio",
                "histratio")


def delta_anti_join(ticks: DataFrame, done: DataFrame, by_symbol: bool = False) -> DataFrame:
    """Ticks whose timestamp text is not yet in the transformed table.

    Faithful key is the timestamp alone (a symbol arriving late at a timestamp
    already transformed for another symbol is skipped); ``by_symbol=True``
    keys by (symbol, timestamp).  Ticks with a NULL timestamp are kept, as in
    ``LEFT JOIN .. WHERE stf.ts IS NULL``.  The right side is de-duplicated
    first (partial aggregation before the shuffle).
    """
    keys = ["symbol", TS] if by_symbol else [TS]
    seen = done.select(*keys).where(F.col(TS).isNotNull()).distinct()
    return ticks.join(seen, keys, "left_anti")


def ratio_query(ticks: DataFrame, done: DataFrame | None, n: int,
                by_symbol: bool = False, carry_history: bool = False,
                materialize: bool = True) -> DataFrame:
    """Q1: transformed rows for the ticks not processed yet.

    Faithful: the window only sees the delta (each run's first n-1 ticks per
    symbol get short windows).  ``carry_history=True`` evaluates the window
    over all ticks and keeps the delta rows, so runs chain seamlessly.

    The delta (J1, a join against the whole history) is read several times by
    the window (hot-key count, chunk tails, frames); ``materialize=True``
    computes it once into a parquet folder of the shared directory (the delta
    holds only the new ticks), from which each reader takes its columns.
    """
    if done is None:
        windowed = moving_avg_rows(ticks, n)
    elif carry_history:
        windowed = delta_anti_join(moving_avg_rows(ticks, n), done, by_symbol)
    else:
        delta = delta_anti_join(ticks, done, by_symbol)
        if materialize:
            from ..session import new_path
            staged = new_path(delta.sparkSession, "delta")
            delta.write.parquet(staged)
            delta = delta.sparkSession.read.schema(delta.schema).parquet(staged)
        windowed = moving_avg_rows(delta, n)
    out = metrics_batch(windowed)
    return out.select("symbol", TS, "avgprice", "pricechange",
                      F.col("avgvolume").alias("avgvol"), "volumechange", "ratio")


def hist_avg_ratio(trans: DataFrame, width: int = TOD_WIDTH) -> DataFrame:
    """A1: ``avg(ratio)`` per (symbol, time of day)."""
    return (trans.groupBy("symbol", tod(TS, width).alias("timehhmmss"))
                 .agg(F.avg("ratio").alias("historicalratio")))


# The usual timestamp text, and how its 14 digits become text again.
FULL_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
DIGITS, AS_TEXT = r"^(....)(..)(..)(..)(..)(..)$", "$1-$2-$3 $4:$5:$6"


def latest_by_tod(trans: DataFrame, width: int = TOD_WIDTH, averaged: bool = False) -> DataFrame:
    """Latest timestamp (``max_ts``) and, if ``averaged``, the average ratio per
    (symbol, time of day).  The maximum of a text would be a sort-based
    aggregate over all rows; texts of the usual form are aggregated as numbers
    (same order, fixed width, hash aggregate) and turned back into text, any
    other text is a group of its own first.  Only the few group rows meet in
    the final text maximum."""
    usual = F.col(TS).rlike(FULL_TEXT)
    number = F.when(usual, F.translate(TS, "-: ", "").cast("long"))
    parts = trans.groupBy("symbol", tod(TS, width).alias("timehhmmss"), F.when(~usual, F.col(TS)).alias("_text")).agg(
        F.max(number).alias("_number"), F.sum("ratio").alias("_sum"), F.count("ratio").alias("_n"))
    text = F.regexp_replace(F.lpad(F.col("_number").cast("string"), 14, "0"), DIGITS, AS_TEXT)
    mean = [F.try_divide(F.sum("_sum"), F.sum("_n")).alias("historicalratio")] if averaged else []
    return parts.groupBy("symbol", "timehhmmss").agg(*mean, F.max(F.coalesce("_text", text)).alias("max_ts"))


def max_ts_by_tod(trans: DataFrame, width: int = TOD_WIDTH) -> DataFrame:
    """A2: latest timestamp per (symbol, time of day)."""
    return latest_by_tod(trans, width)


def semi_latest(trans: DataFrame, latest: DataFrame, ts_col: str = "max_ts") -> DataFrame:
    """Rows whose timestamp equals the latest timestamp of *any* group
    (uncorrelated ``IN``: planned as a left semi join on the timestamp)."""
    return trans.join(latest.select(F.col(ts_col).alias(TS)).distinct(), TS, "left_semi")


def hist_join_latest(groups: DataFrame, latest_rows: DataFrame, width: int = TOD_WIDTH) -> DataFrame:
    """Group averages joined to the latest rows on (symbol, time of day)."""
    return latest_rows.withColumn("timehhmmss", tod(TS, width)).join(groups, ["symbol", "timehhmmss"])


def hist_ratio_query(trans: DataFrame, width: int = TOD_WIDTH, rounded: bool = True) -> DataFrame:
    """Q2, faithful: may return several rows per (symbol, time of day) when a
    row's timestamp is the latest of another symbol's group.

    A1 and A2 share one aggregation (one scan and one shuffle of the table);
    the second scan feeds the semi join.
    """
    groups = latest_by_tod(trans, width, averaged=True)
    latest_rows = semi_latest(trans, groups)
    j = hist_join_latest(groups.drop("max_ts"), latest_rows, width)
    return history_columns(j, rounded)


def history_columns(joined: DataFrame, rounded: bool = True) -> DataFrame:
    """The history table's columns of Q2's join."""
    r = round5 if rounded else (lambda c: F.col(c))
    return joined.select("symbol", F.col("timehhmmss").alias(TS),
                         r("avgprice").alias("avgprice"), r("pricechange").alias("pricechange"),
                         r("avgvol").alias("avgvolume"), r("volumechange").alias("volumechange"),
                         r("ratio").alias("ratio"), r("historicalratio").alias("histratio"))


def hist_ratio_strict(trans: DataFrame, width: int = TOD_WIDTH, rounded: bool = True) -> DataFrame:
    """Q2, one row per (symbol, time of day): the group's latest row (ties
    broken by the remaining columns) and the group's average ratio, in one
    aggregation (no join, no second scan)."""
    last = F.max(F.struct(TS, "avgprice", "pricechange", "avgvol", "volumechange", "ratio"))
    g = (trans.groupBy("symbol", tod(TS, width).alias("timehhmmss"))
              .agg(F.avg("ratio").alias("historicalratio"), last.alias("_last")))
    r = round5 if rounded else (lambda c: F.col(c))
    return g.select("symbol", F.col("timehhmmss").alias(TS),
                    r("_last.avgprice").alias("avgprice"), r("_last.pricechange").alias("pricechange"),
                    r("_last.avgvol").alias("avgvolume"), r("_last.volumechange").alias("volumechange"),
                    r("_last.ratio").alias("ratio"), r("historicalratio").alias("histratio"))


# ---- Q2 kept up to date run by run ---------------------------------------------------
#
# A run's new rows have timestamps of their own (J1), so what Q2 needs of all
# earlier rows is one row per (symbol, time of day), and the rows at timestamps
# that are the latest of some group: a group's latest timestamp stays one of
# these or becomes one of the new rows'.

GROUPS = "symbol string, timehhmmss string, total double, n long, max_ts string"


def group_partials(trans: DataFrame, width: int = TOD_WIDTH) -> DataFrame:
    """Sum and count of the ratios and latest timestamp per (symbol, time of day)."""
    latest = latest_by_tod(trans, width)
    sums = trans.groupBy("symbol", tod(TS, width).alias("timehhmmss")).agg(
        F.coalesce(F.sum("ratio"), F.lit(0.0)).alias("total"), F.count("ratio").alias("n"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}")) for c in ("symbol", "timehhmmss")]
    return sums.alias("s").join(latest.alias("l"), same[0] & same[1]).select("s.*", "l.max_ts")


def merged_groups(old: DataFrame, new: DataFrame) -> DataFrame:
    """Groups of earlier runs and of this one, merged."""
    both = old.unionByName(new)
    return both.groupBy("symbol", "timehhmmss").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("max_ts").alias("max_ts"))


def rows_at_latest(kept: DataFrame, delta: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows at timestamps that are now the latest of some group: from those
    kept by the run before and from the new rows."""
    return semi_latest(kept.unionByName(delta.select(*kept.columns)), groups)


def hist_ratio_from_groups(groups: DataFrame, latest_rows: DataFrame, width: int = TOD_WIDTH,
                           rounded: bool = True) -> DataFrame:
    """Q2, faithful, from merged groups and the rows at latest timestamps."""
    mean = groups.select("symbol", "timehhmmss", F.try_divide("total", "n").alias("historicalratio"))
    return history_columns(hist_join_latest(mean, latest_rows, width), rounded)


def tod_avg_price_volume(ticks: DataFrame, width: int = TOD_WIDTH) -> DataFrame:
    """``avg(price), avg(volume)`` per (symbol, time of day)."""
    return (ticks.groupBy("symbol", tod(TS, width).alias("timehhmmss"))
                 .agg(F.avg("price").alias("avgprice"), F.avg("volume").alias("avgvol")))
