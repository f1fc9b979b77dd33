"""Feeds (Q6-Q10, A3-A5, A8, U1, F4), JSON payloads, keyed sinks (K2, K3),
connector options."""
import glob
import json
import os

import pytest

from tickwise import schemas as S
from tickwise.operators import feeds as FD
from tickwise.session import local_path, new_path
from tickwise.sources import connectors as C
from tickwise.sources.sinks import first_wins_append, upsert_last_wins

ALERT_DDL = ("symbol string, timestampvalue string, histratio double, currentratio double, "
             "ratiodeviation double, threshold double")
STOCK_DDL = ("symbol string, timestampvalue string, price double, volume double, priceavg double, "
             "pricechange double, volumeavg double, volumechange double, ratio double")


def test_pivot_empty_input(spark):
    empty = spark.createDataFrame([], ALERT_DDL)
    r = FD.alert_pivot_feed(empty).collect()
    assert len(r) == 1
    d = r[0].asDict()
    assert d["TOTAL"] == 0 and all(d[s] is None for s in FD.PIVOT_SYMBOLS)
    assert FD.alert_total(empty).collect()[0].alerts == 0
    assert FD.high_watermark(empty).collect()[0][0] is None


def test_pivot_and_counts(spark):
    a = spark.createDataFrame([("TCS", "2024-01-01 00:00:01", 1.0, 1.0, 1.0, 0.0),
                               ("TCS", "2024-01-01 00:00:02", 1.0, 1.0, 1.0, 0.0),
                               ("SBI", "2024-01-01 00:00:02", 1.0, 1.0, 1.0, 0.0)], ALERT_DDL)
    d = FD.alert_pivot_feed(a).collect()[0].asDict()
    assert d == {"HDFC": None, "ONGC": None, "RELIANCE": None, "SBI": 1, "TCS": 2, "TOTAL": 3}
    assert {r.symbol: r["count"] for r in FD.alert_counts(a).collect()} == {"TCS": 2, "SBI": 1}
    payload = [json.loads(r.json) for r in FD.count_payload_rows(FD.alert_counts(a)).collect()]
    assert {"symbol": "TCS", "count": "2"} in payload


def test_dashboard_feed_late_alert_and_mark(spark):
    stock = spark.createDataFrame([("A", "2024-01-01 00:00:01", 1.0, 1.0, 1.0, 0.0, 1.0, 0.0, 0.0),
                                   ("A", "2024-01-01 00:00:02", 2.0, 1.0, 1.5, 33.3, 1.0, 0.0, 0.0)],
                                  STOCK_DDL)
    none = spark.createDataFrame([], ALERT_DDL)
    first = FD.dashboard_feed(stock, none, None).collect()
    assert [r.alertFlag for r in first] == [0, 0]
    mark = max(r.tmst for r in first)
    # The alert for the first row arrives later; the next poll only sees newer rows
    late = spark.createDataFrame([("A", "2024-01-01 00:00:01", 1.0, 5.0, 400.0, -100.0)], ALERT_DDL)
    assert FD.dashboard_feed(stock, late, mark).count() == 0
    again = {r.tmst: r for r in FD.dashboard_feed(stock, late, None).collect()}
    assert again["2024-01-01 00:00:01"].alertFlag == 1
    assert again["2024-01-01 00:00:01"].dateValue == "2024-01-01"
    assert again["2024-01-01 00:00:01"].timeValue == "00:00:01"


def test_alert_feed_and_digest(spark):
    a = spark.createDataFrame([("A", "2024-01-01 00:00:01.5", 1.0, 2.0, 100.0, -100.0),
                               ("B", "2024-01-01 00:00:03", 1.0, 2.0, 1.0e8, -100.0)], ALERT_DDL)
    f = FD.alert_feed(a, "2024-01-01 00:00:01").collect()
    assert [r.timestampValue for r in f] == ["2024-01-01 00:00:01", "2024-01-01 00:00:03"]
    assert all(r.Alert == 1 for r in f)
    d = FD.alert_digest(a, None).collect()
    assert d[0].subject == "STOCK PRICE ALERTS from 2024-01-01 00:00:01.5 to 2024-01-01 00:00:01.5"
    assert d[1].subject == "STOCK PRICE ALERTS from 2024-01-01 00:00:01.5 to 2024-01-01 00:00:03.0"
    assert d[1].body == ("Symbol = B , Time = 2024-01-01 00:00:03 , Historical Ratio = 1.0 , "
                         "Current Ratio = 2.0 , Ratio Deviation = 1.0E8 , Threshold = -100.0")


def test_json_payload_writer(spark):
    out = new_path(spark, "payloads")
    os.makedirs(local_path(out), exist_ok=True)

    def writer(payload, _dir=local_path(out)):
        import uuid
        with open(os.path.join(_dir, uuid.uuid4().hex + ".json"), "w") as fh:
            fh.write(payload)

    a = spark.createDataFrame([("A", "t", None, 2.0, 3.0, -100.0)], ALERT_DDL)
    FD.post_json_payloads(FD.json_rows(a), writer)
    files = glob.glob(os.path.join(local_path(out), "*.json"))
    rows = [r for f in files for r in json.load(open(f))]
    assert rows == [{"symbol": "A", "timestampvalue": "t", "histratio": None, "currentratio": 2.0,
                     "ratiodeviation": 3.0, "threshold": -100.0}]


def test_first_wins_append_idempotent(spark):
    path = new_path(spark, "k2")
    b0 = spark.createDataFrame([("A", "2024-01-01 00:00:01", 1.0, 2.0, 3.0, 0.0, 1),
                                ("A", "2024-01-01 00:00:01", 9.0, 9.0, 9.0, 0.0, 0)],
                               ALERT_DDL + ", tick_id long")
    first_wins_append(b0, path, 0, S.ALERT)
    b1 = spark.createDataFrame([("A", "2024-01-01 00:00:01", 5.0, 5.0, 5.0, 0.0, 7),
                                ("A", "2024-01-01 00:00:02", 5.0, 5.0, 5.0, 0.0, 8)],
                               ALERT_DDL + ", tick_id long")
    first_wins_append(b1, path, 1, S.ALERT)
    first_wins_append(b1, path, 1, S.ALERT)          # replayed batch: no duplicates
    rows = {(r.symbol, r.timestampvalue): r.histratio for r in spark.read.parquet(path).collect()}
    assert rows == {("A", "2024-01-01 00:00:01"): 9.0, ("A", "2024-01-01 00:00:02"): 5.0}


def test_upsert_last_wins(spark):
    v1 = upsert_last_wins(spark, None, spark.createDataFrame(
        [("A", "09:00:00", 1.0), ("B", "09:00:00", 2.0)], "symbol string, timestampvalue string, histratio double"),
        new_path(spark, "k3"))
    v2 = upsert_last_wins(spark, v1, spark.createDataFrame(
        [("A", "09:00:00", 7.0, 1), ("A", "09:00:00", 8.0, 2)],
        "symbol string, timestampvalue string, histratio double, seq int"), new_path(spark, "k3"), seq="seq")
    got = {r.symbol: r.histratio for r in spark.read.parquet(v2).collect()}
    assert got == {"A": 8.0, "B": 2.0}


def test_connector_options():
    o = C.kafka_options("h:9092", ["t1", "t2"])
    assert o["subscribe"] == "t1,t2" and o["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in o and "failOnDataLoss" not in o      # no cap, no silent loss
    assert C.kafka_options("h:9092", "t", max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    j = C.jdbc_query_options("jdbc:x", table="stock", partition_column="id", lower=0, upper=9,
                             num_partitions=4)
    assert j["numPartitions"] == "4" and j["dbtable"] == "stock"
    with pytest.raises(ValueError):
        C.jdbc_query_options("jdbc:x", query="select 1", partition_column="id")


def test_csv_sink(spark):
    from tickwise.sources.sinks import csv_table
    path = new_path(spark, "csv")
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol string, ratio double")
    csv_table(df, path)
    back = spark.read.option("header", "true").csv(path)
    assert sorted((r.symbol, float(r.ratio)) for r in back.collect()) == [("A", 1.0), ("B", 2.0)]


def test_first_wins_append_over_texts_that_are_no_dates(spark):
    """Every key once, whatever its time text; a NULL time is a key like any other."""
    odd = ["16/01/2024 09:00:00", "09:00:00.123", "2024,01,16 09:00", "{bad json} x", "2024-01-16 09:00:00", None, ""]
    ddl = ALERT_DDL + ", tick_id long"
    path = new_path(spark, "k2-odd")
    for batch_id in range(2):
        rows = [("A", t, float(batch_id), 2.0, 3.0, 0.0, 10 * batch_id + i) for i, t in enumerate(odd)]
        first_wins_append(spark.createDataFrame(rows, ddl), path, batch_id, S.ALERT)
    got = spark.read.parquet(path).collect()
    assert sorted(map(str, (r.timestampvalue for r in got))) == sorted(map(str, odd))
    assert {r.histratio for r in got} == {0.0}
    folders = os.listdir(local_path(path))
    assert sum(f.startswith("datevalue=") for f in folders) == 2


def test_first_wins_keeps_whole_rows(spark):
    from tickwise.operators.alerts import first_wins
    ddl = ALERT_DDL + ", tick_id long"
    rows = [("A", "t", 1.0, None, 3.0, 0.0, 5), ("A", "t", 2.0, 9.0, 1.0, 0.0, 5),
            ("B", "t", 4.0, 5.0, 6.0, 0.0, None), ("B", "t", 7.0, 8.0, 9.0, 0.0, None)]
    got = {r.symbol: tuple(r)[2:5] for r in first_wins(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {"A": (1.0, None, 3.0), "B": (4.0, 5.0, 6.0)}


def test_only_a_missing_table_counts_as_empty(spark):
    from tickwise.sources.sinks import read_or_none
    path = new_path(spark, "broken")
    assert read_or_none(spark, path) is None
    os.makedirs(local_path(path))
    assert read_or_none(spark, path) is None
    with open(os.path.join(local_path(path), "x.parquet"), "w") as f:
        f.write("no parquet file")
    with pytest.raises(Exception):
        read_or_none(spark, path).count()


def test_payload_keys(spark):
    out = new_path(spark, "keyed-payloads")
    os.makedirs(local_path(out), exist_ok=True)

    def writer(payload, key, _dir=local_path(out)):
        with open(os.path.join(_dir, key), "w") as fh:
            fh.write(payload)

    df = spark.range(5).coalesce(1).selectExpr("cast(id as string) as json")
    for _ in range(2):                        # sent again under the same keys
        FD.post_json_payloads(df, writer, max_rows=2, batch_id=7)
    assert sorted(os.listdir(local_path(out))) == ["7-0-0", "7-0-1", "7-0-2"]


def test_shared_folder_is_required_on_a_cluster():
    from tickwise.session import shared_dir

    class Context:
        master = "yarn"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
