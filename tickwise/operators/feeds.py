"""Dashboard and mail feeds over the ``stock`` and ``stock_alert`` tables
(Q6-Q10, A3-A5, A8, U1, F4, JSON payloads).

The source polled these tables on a timer with a high-water mark kept in
memory.  Each feed here is a DataFrame function of the tables and an optional
mark (``since``): the rows strictly after the mark in text order.  For a
continuous feed the mark is not needed: ``tickwise.streaming.feeds`` reads the
tables as streams and the checkpoint remembers what was delivered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DATE_LEN, TOD_START, TOD_WIDTH, TS_TEXT_LEN, text_template

TS = "timestampvalue"

# Fixed values of the source system's feeds --------------------------------------
# payload columns of the dashboard feeds (key order of the JSON)
DASHBOARD_COLUMNS = ("symbol", "tmst", "dateValue", "timeValue", "currentratio", "histratio",
                     "ratiodeviation", "threshold", "alertFlag", "price", "volume", "priceavg",
                     "pricechange", "volumeavg", "volumechange")
ALERT_FEED_COLUMNS = ("symbol", "timestampValue", "dateValue", "timeValue", "histratio",
                      "currentratio", "ratiodeviation", "threshold", "Alert")
# symbols of the pivot feed (the default of alert_pivot_feed) and its total column
PIVOT_SYMBOLS = ("HDFC", "ONGC", "RELIANCE", "SBI", "TCS")
TOTAL = "TOTAL"
# mail digest subject and body texts
DIGEST_SUBJECT = "STOCK PRICE ALERTS from {first} to {last}"
DIGEST_BODY = ("Symbol = {symbol} , Time = {ts} , Historical Ratio = {hist} , "
               "Current Ratio = {current} , Ratio Deviation = {deviation} , Threshold = {threshold}")
# ----------------------------------------------------------------------------------


def incremental_filter(df: DataFrame, since: str | None, ts: str = TS) -> DataFrame:
    """``ts > since`` as a strict text comparison (pushed into the parquet
    scan when ``ts`` is a stored column); no mark: everything."""
    return df if since is None else df.where(F.col(ts) > F.lit(since))


def high_watermark(df: DataFrame, ts: str = TS) -> DataFrame:
    """The next poll's mark, ``max(ts)`` (one row; NULL when empty)."""
    return df.agg(F.max(ts).alias("high_watermark"))


def dashboard_feed(stock: DataFrame, alerts: DataFrame, since: str | None = None,
                   ordered: bool = True) -> DataFrame:
    """Q6: stock rows after the mark, left-joined to their alert (J5) on the
    primary key, 15 columns, in time order.  A stock row delivered before its
    alert was written keeps alertFlag 0 (the feed never revisits rows)."""
    c = incremental_filter(stock, since).alias("c")
    a = alerts.select("symbol", TS, "currentratio", "histratio", "ratiodeviation",
                      "threshold").alias("a")
    j = c.join(a, ["symbol", TS], "left")
    out = j.select(
        "symbol", F.col(TS).alias("tmst"),
        F.substring(TS, 1, DATE_LEN).alias("dateValue"),
        F.substring(TS, TOD_START, TOD_WIDTH).alias("timeValue"),
        F.coalesce("a.currentratio", F.lit(0.0)).alias("currentratio"),
        F.coalesce("a.histratio", F.lit(0.0)).alias("histratio"),
        F.coalesce("a.ratiodeviation", F.lit(0.0)).alias("ratiodeviation"),
        F.coalesce("a.threshold", F.lit(0.0)).alias("threshold"),
        F.when(F.col("a.ratiodeviation").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("alertFlag"),
        "c.price", "c.volume", "c.priceavg", "c.pricechange", "c.volumeavg", "c.volumechange")
    # (timestamp, symbol) is the primary key: a unique sort key lets the range
    # partitioner split a second shared by many symbols across tasks
    return out.orderBy("tmst", "symbol") if ordered else out


def alert_feed(alerts: DataFrame, since: str | None = None, ordered: bool = True) -> DataFrame:
    """Q7: alert rows after the mark, timestamp cut to 19 characters, with a
    constant ``Alert = 1`` column, in time order."""
    a = incremental_filter(alerts, since)
    out = a.select("symbol", F.substring(TS, 1, TS_TEXT_LEN).alias("timestampValue"),
                   F.substring(TS, 1, DATE_LEN).alias("dateValue"),
                   F.substring(TS, TOD_START, TOD_WIDTH).alias("timeValue"),
                   "histratio", "currentratio", "ratiodeviation", "threshold",
                   F.lit(1).alias("Alert"))
    return out.orderBy("timestampValue", "symbol") if ordered else out


def alert_counts(alerts: DataFrame) -> DataFrame:
    """A3 / Q8: number of alerts per symbol (partial aggregation per task)."""
    return alerts.groupBy("symbol").agg(F.count(F.lit(1)).alias("count"))


def alert_total(alerts: DataFrame) -> DataFrame:
    """A5: ``'TOTAL', count(symbol)`` without grouping: one row, 0 when empty."""
    return alerts.agg(F.lit(TOTAL).alias("symbol"), F.count("symbol").alias("alerts"))


def _total_of(counts: DataFrame) -> Column:
    """``count(symbol)`` from the per-symbol counts (NULL symbols not counted)."""
    known = F.sum(F.when(F.col("symbol").isNotNull(), F.col("alerts")))
    return F.coalesce(known, F.lit(0)).cast("long")


def alerts_with_total(alerts: DataFrame) -> DataFrame:
    """Per-symbol counts ``UNION ALL`` the total row.  The total is the sum
    of the counts, so the alerts are read once and both branches share one
    shuffle."""
    per = alerts.groupBy("symbol").agg(F.count(F.lit(1)).alias("alerts"))
    return per.unionByName(per.agg(F.lit(TOTAL).alias("symbol"), _total_of(per).alias("alerts")))


def pivot_counts(counts: DataFrame, symbols: Sequence[str] = PIVOT_SYMBOLS) -> DataFrame:
    """One row with a column per listed symbol (NULL when it has no alert) and
    ``TOTAL``, from per-symbol counts, in one aggregation."""
    return counts.agg(*[F.max(F.when(F.col("symbol") == F.lit(s), F.col("alerts"))).alias(s) for s in symbols],
                      F.greatest(_total_of(counts), F.max(F.when(F.col("symbol") == F.lit(TOTAL), F.col("alerts"))))
                      .alias(TOTAL))


def alert_pivot_feed(alerts: DataFrame, symbols: Sequence[str] = PIVOT_SYMBOLS) -> DataFrame:
    """Q9 / A4: the pivot of U1 over a fixed list, so Spark needs no extra job
    to find the values (a symbol named like the total takes part in its
    column, as in the union)."""
    return pivot_counts(alerts.groupBy("symbol").agg(F.count(F.lit(1)).alias("alerts")), symbols)


def java_ts_text(c) -> Column:
    """``java.sql.Timestamp.valueOf(text).toString()``: a timestamp text
    without fraction gets ``.0``; fraction digits are kept without trailing
    zeros.  Text that is not a timestamp gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.substring(c, 1, TS_TEXT_LEN)
    frac = F.regexp_extract(c, r"^.{19}\.(\d+)$", 1)
    frac = F.regexp_replace(frac, "0+$", "")
    ok = F.try_to_timestamp(base, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    return F.when(ok, F.concat(base, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac)))


def alert_digest(alerts: DataFrame, since: str | None = None, ordered: bool = True) -> DataFrame:
    """Q10: one mail text per alert after the mark, in time order, with the
    subject ``STOCK PRICE ALERTS from <first> to <last>`` where first is the
    poll's first timestamp and last the running latest (W3).  Delivery is not
    built; these rows are what would be sent.  ``alerts`` is read twice (first
    timestamp, rows): pass a stored table, as the poller read one."""
    from .windows import running_first_last
    a = running_first_last(incremental_filter(alerts, since), TS)
    body = text_template(DIGEST_BODY, symbol="symbol", ts=TS, hist="histratio",
                         current="currentratio", deviation="ratiodeviation", threshold="threshold")
    subject = text_template(DIGEST_SUBJECT, first=java_ts_text("first_ts"),
                            last=java_ts_text("last_ts"))
    out = a.select("symbol", TS, subject.alias("subject"), body.alias("body"))
    return out.orderBy(TS, "symbol") if ordered else out


def json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON object text per row (keys in column order, NULL as ``null``)."""
    cols = list(columns or df.columns)
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def count_payload_rows(df: DataFrame) -> DataFrame:
    """The count feeds quote their numbers (``"count" : "3"``)."""
    return json_rows(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


def post_json_payloads(json_df: DataFrame, writer: Callable[..., None],
                       max_rows: int = 10_000, batch_id: int | None = None) -> None:
    """Hand JSON arrays of at most ``max_rows`` rows to ``writer`` from each
    task (no driver round trip, nothing sent for an empty partition; the source
    sent one array per poll, so ``max_rows`` belongs to the writer's protocol).
    Payloads of different tasks arrive in any order: consumers order by the
    rows' time.  With ``batch_id``, ``writer(payload, key)`` also gets a key
    (batch, partition, number) that is the same when a task is retried.
    ``writer`` must be picklable and should accept HTTP 200/202 semantics
    itself (raise on failure so the task retries)."""
    from ..session import ship_package
    ship_package(json_df.sparkSession)

    def send(rows: Iterable) -> None:
        from pyspark import TaskContext
        buf: list[str] = []
        sent = 0

        def post() -> None:
            payload = "[" + ",".join(buf) + "]"
            if batch_id is None:
                writer(payload)
            else:
                writer(payload, f"{batch_id}-{TaskContext.get().partitionId()}-{sent}")

        for r in rows:
            buf.append(r[0])
            if len(buf) >= max_rows:
                post()
                buf, sent = [], sent + 1
        if buf:
            post()
    json_df.foreachPartition(send)
