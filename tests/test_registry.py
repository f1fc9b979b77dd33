"""Every registered query against its DuckDB oracle (sf0.001), and the
driver entry point."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import check, duck  # noqa: E402

from tickwise.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())       # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(NAMES)
    assert set(E.queries()) >= set(NAMES) and set(E.oracle_sql()) >= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = check(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert r["cols"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"] or r["approx"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "timestampvalue", "avgprice", "pricechange", "avgvol",
                          "volumechange", "ratio"]


@pytest.mark.parametrize("name", ["ratio_query", "metrics_batch", "realtime_ratio", "stock_rows",
                                  "ratio_alerts", "dashboard_feed", "moving_avg_rows"])
def test_hot_symbol_split_matches_oracle(spark, con, name):
    """With a tiny task size every symbol is hot and split into time chunks;
    the composed queries must still equal the oracle."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")     # 32 ticks per task
    try:
        df = E.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "_tw_chunk" in plan and "WindowGroupLimit" in plan
        r = check(spark, con, SF, name, lambda s, d: df, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert r["spark_rows"] == r["duck_rows"] and (r["exact"] or r["approx"]), r


@pytest.mark.parametrize("name", ["moving_avg_rows_lineitem", "ratio_query", "alert_digest"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = check(spark, con, SF, name, E.queries()[name], E.oracle_sql()[name])
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["spark_rows"] == r["duck_rows"] and (r["exact"] or r["approx"]), r
