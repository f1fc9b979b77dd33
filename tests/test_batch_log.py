"""Micro-batch log, pinned history runs, arrival positions (the queries built
on them are compared with their SQL in test_registry)."""
import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tickwise.functions.columns import arrival_position
from tickwise.plans import registry
from tickwise.session import new_path
from tickwise.sources.connectors import with_positions
from tickwise.sources.sinks import RUN, pinned_run
from tickwise.streaming.batch_log import BatchLog, logged_watermark, read_log
from tickwise.streaming.keyed_window import range_of

SF001 = "/root/testdata/sf0.001"


def _logged(spark, path, batch_id, rows):
    log = BatchLog(path, batch_id)
    log.observed(spark.createDataFrame(rows, "symbol string, timestampvalue string")).write.parquet(new_path(spark, "rows"))
    return log.store()


def test_log_rows_marks_and_replay(spark):
    path = new_path(spark, "log")
    assert read_log(spark, path).count() == 0
    assert logged_watermark(spark, path).first()[0] is None
    assert _logged(spark, path, 0, [("a", "2024-01-02"), ("b", "2024-01-05")]) == 2
    assert _logged(spark, path, 1, []) == 0
    assert _logged(spark, path, 2, [("a", "2024-01-03"), ("b", None)]) == 2
    assert _logged(spark, path, 2, [("a", "2024-01-04")]) == 1              # a replay replaces its row
    assert sorted(map(tuple, read_log(spark, path).collect())) == [
        (0, 2, "2024-01-05"), (1, 0, None), (2, 1, "2024-01-04")]
    assert logged_watermark(spark, path).first()[0] == "2024-01-05"


def test_a_replay_reads_the_run_of_its_first_attempt(spark):
    path, pins = new_path(spark, "hist"), new_path(spark, "pins")
    assert pinned_run(spark, path, pins, 0) is None
    for run in (3, 10):
        spark.range(1).write.parquet(f"{path}/{RUN}={run}")
        assert pinned_run(spark, path, pins, run) == run
    assert pinned_run(spark, path, pins, 3) == 3
    assert pinned_run(spark, path, pins, 0) is None


def test_positions_sort_as_topic_partition_offset(spark):
    places = [("a", 2, 9), ("a", 10, 1), ("a", 2, 10), ("a-b", 0, 0), ("a.b", 0, 123456789012), ("b", 0, 5)]
    df = spark.createDataFrame([(str(p), *p) for p in places], "value string, topic string, partition int, offset long")
    got = [r[0] for r in with_positions(df).orderBy("offset").collect()]
    assert got == [str(p) for p in sorted(places)]


def test_ranges_of_positions_keep_the_order(spark):
    rows = [("t", p, o) for p in (0, 3) for o in (0, 99_999, 100_000, 250_000)] + [("t-u", 0, 7)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    texts = sorted(r[0] for r in df.select(arrival_position()).collect())
    ranges = list(range_of(pd.Series([None, *texts])))
    assert ranges == sorted(ranges)
    assert len(set(ranges)) == 1 + 3 + 3 + 1


def test_topic_order_differs_from_time_order(spark):
    """The two-topic row would fail with windows in time order."""
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF001}/events.parquet'")
    a = con.execute(registry.oracle_sql()["stock_rows_two_topics"]).fetchall()
    b = con.execute(registry._LIVE_STOCK_SQL).fetchall()
    assert sorted(map(str, a)) != sorted(map(str, b))
