"""J1, Q1, Q2 (D5-D7, D11) and J3/F2/F3/Q4/Q5 (D3, D4, no history)."""
from pyspark.sql import functions as F

from tickwise.operators.alerts import (alert_messages, alert_rows, first_wins,
                                       hist_lookup_join, ratio_alerts, realtime_ratio)
from tickwise.operators.history import (delta_anti_join, hist_ratio_query, hist_ratio_strict,
                                        ratio_query)

TRANS_DDL = ("symbol string, timestampvalue string, avgprice double, pricechange double, "
             "avgvol double, volumechange double, ratio double")


def test_delta_key_is_timestamp_only(make_ticks):
    # late symbol: B arrives at a timestamp already transformed for A -> lost
    ticks = make_ticks([("A", "2024-01-01 00:00:01", 1.0, 1, 1), ("B", "2024-01-01 00:00:01", 2.0, 1, 2),
                        ("B", "2024-01-01 00:00:02", 2.0, 1, 3), ("C", None, 1.0, 1, 4)])
    done = ratio_query(ticks.where("tick_id = 1"), None, 3)
    got = sorted(r.tick_id for r in delta_anti_join(ticks, done).collect())
    assert got == [3, 4]                                # NULL timestamp kept
    got = sorted(r.tick_id for r in delta_anti_join(ticks, done, by_symbol=True).collect())
    assert got == [2, 3, 4]


def test_delta_window_does_not_see_history(make_ticks):
    # Each run's first n-1 rows get short windows unless carry_history
    ticks = make_ticks([("A", f"2024-01-01 00:00:0{i}", float(i + 1), i + 1, i) for i in range(4)])
    done = ratio_query(ticks.where("tick_id < 2"), None, 3)
    faithful = {r.timestampvalue: r.avgprice for r in ratio_query(ticks, done, 3).collect()}
    assert faithful == {"2024-01-01 00:00:02": 3.0, "2024-01-01 00:00:03": 3.5}
    carried = {r.timestampvalue: r.avgprice for r in ratio_query(ticks, done, 3, carry_history=True).collect()}
    assert carried == {"2024-01-01 00:00:02": 2.0, "2024-01-01 00:00:03": 3.0}


def test_hist_faithful_vs_strict_unequal_coverage(spark):
    # A on days 1-2, B on day 1 only, same time of day
    rows = [("A", "2024-01-01 09:00:00", 1.0, 0.0, 1.0, 0.0, 1.0),
            ("A", "2024-01-02 09:00:00", 1.0, 0.0, 1.0, 0.0, 3.0),
            ("B", "2024-01-01 09:00:00", 1.0, 0.0, 1.0, 0.0, 5.0)]
    trans = spark.createDataFrame(rows, TRANS_DDL)
    faithful = hist_ratio_query(trans, 8).collect()
    a_rows = [r for r in faithful if r.symbol == "A"]
    assert len(a_rows) == 2                              # latest of B's group matches A's day-1 row
    assert {r.histratio for r in a_rows} == {2.0}
    strict = {r.symbol: r for r in hist_ratio_strict(trans, 8).collect()}
    assert len(strict) == 2 and strict["A"].ratio == 3.0 and strict["A"].histratio == 2.0


def _hist(spark, rows):
    return spark.createDataFrame(rows, "symbol string, timestampvalue string, histratio double")


def test_alerts_zero_negative_and_missing_history(spark, make_ticks):
    live = make_ticks([("A", "2024-01-20 09:00:00", 10.0, 1, 1), ("A", "2024-01-20 09:00:01", 11.0, 3, 2),
                       ("B", "2024-01-20 09:00:01", 10.0, 1, 3), ("B", "2024-01-20 09:00:02", 11.0, 3, 4),
                       ("C", "2024-01-20 09:00:01", 10.0, 1, 5), ("C", "2024-01-20 09:00:02", 11.0, 3, 6)])
    hist = _hist(spark, [("A", "09:00:01", -0.5), ("B", "09:00:02", 0.0)])   # C: no history
    rows = {r.symbol: r for r in realtime_ratio(live, 2).collect() if r.tick_id in (2, 4, 6)}
    got = {r.symbol: r for r in ratio_alerts(live, hist, 2, -1e9, width=8).collect()}
    assert set(got) == {"A"}                             # hist 0 -> no alert; no history -> none
    dev = (rows["A"].ratio - (-0.5)) * 100 / (-0.5)      # D4: negative history flips the sign
    assert abs(got["A"].ratiodeviation - round(dev, 5)) < 1e-9
    assert got["A"].threshold == -1e9


def test_threshold_is_strict_and_sentinel_value_alerts(spark, make_ticks):
    live = make_ticks([("A", "2024-01-20 09:00:00", 10.0, 1, 1)])
    rows = realtime_ratio(live, 1)
    # ratio is 0 (price = avg): dev = (0 - h) * 100 / h = -100
    hist = _hist(spark, [("A", "09:00:00", 2.0)])
    j = hist_lookup_join(rows, hist, 8)
    assert alert_rows(j, -100.0).count() == 0            # strict >
    assert alert_rows(j, -100.5).count() == 1
    # D3: a deviation of exactly 99999.0 is an alert here (no sentinel)
    j2 = j.withColumn("ratio", F.lit(1000.99)).withColumn("histratio", F.lit(1.0))
    r = alert_rows(j2, 0.0).collect()
    assert len(r) == 1 and r[0].ratiodeviation == 99999.0


def test_first_wins_and_messages(spark):
    df = spark.createDataFrame([("A", "t1", 1.0, 2.0, 3.0, -100.0, 5), ("A", "t1", 9.0, 9.0, 9.0, -100.0, 2)],
                               "symbol string, timestampvalue string, histratio double, "
                               "currentratio double, ratiodeviation double, threshold double, tick_id long")
    r = first_wins(df).collect()
    assert len(r) == 1 and r[0].histratio == 9.0
    m = alert_messages(df.where("tick_id = 5")).collect()[0].message
    assert m == (" Alert has generated for stock A and timestamp t1. Historic Ratio : 1.0, "
                 "Current Ratio : 2.0, Ratio deviation : 3.0, Threshold : -100.0")


def test_bad_timestamps_never_match_history(spark):
    from tickwise.functions.columns import tod_of_raw
    df = spark.createDataFrame([('"2024-01-01 09:00:00"',), ("2024-01-01T09:00:00",), ("2024-01-01 9:00",),
                                (None,)], "ts string")
    got = [r[0] for r in df.select(tod_of_raw("ts")).collect()]
    assert got == ["09:00:00", None, "9:00", None]


def test_duplicate_keys_first_insert_wins(make_ticks):
    from tickwise.operators.alerts import stock_rows
    rows = [("A", "2024-01-01 00:00:01", 10.0, 1, 1), ("A", "2024-01-01 00:00:01", 99.0, 1, 2),
            ("A", "2024-01-01 00:00:02", 11.0, 1, 3)]
    got = {r.timestampvalue: r.price for r in stock_rows(make_ticks(rows), 2).collect()}
    assert got == {"2024-01-01 00:00:01": 10.0, "2024-01-01 00:00:02": 11.0}


def test_nan_history_never_alerts(spark, make_ticks):
    live = make_ticks([("A", "2024-01-20 09:00:00", 10.0, 1, 1)])
    hist = _hist(spark, [("A", "09:00:00", float("nan"))])
    assert alert_rows(hist_lookup_join(realtime_ratio(live, 1), hist, 8), -1e300).count() == 0


def test_quotes_kept_when_not_cleaned(spark):
    from tickwise.operators.alerts import realtime_metrics
    from tickwise.operators.windows import moving_avg_rows
    from tickwise.operators.parse import parse_tick_lenient
    df = spark.createDataFrame([('{"symbol":"A","timestampValue":"2024-01-01 00:00:01","price":1,"volume":1}', 1)],
                               "value string, offset long")
    t = parse_tick_lenient(df, keep=("offset",)).withColumnRenamed("offset", "tick_id")
    w = moving_avg_rows(t, 3, outputs=("priceavg", "volumeavg"))
    assert realtime_metrics(w, clean=False).first().symbol == '"A"'
    assert realtime_metrics(w).first().symbol == "A"


def test_latest_text_of_any_form(spark):
    """The number path gives the text maximum, also among texts of other forms."""
    from tickwise.operators.history import latest_by_tod
    texts = ["2024-01-01 09:00:00", "2024-01-02 09:00:00", "2024-01-02 09:00:00.5", "2024-01-02 09:00", "x", None, "9999-99-99 09:00:00"]
    rows = [(s, t, 0.0, 0.0, 0.0, 0.0, float(i)) for i, t in enumerate(texts) for s in ("A", "B") if (s, i) != ("B", 6)]
    trans = spark.createDataFrame(rows, TRANS_DDL)
    got = sorted(map(tuple, latest_by_tod(trans, averaged=True).collect()), key=repr)
    want = sorted(map(tuple, trans.groupBy("symbol", F.substring("timestampvalue", 12, 8)).agg(
        F.avg("ratio"), F.max("timestampvalue")).collect()), key=repr)
    assert got == want
