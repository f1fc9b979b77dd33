"""The batch ratio job over two runs, and history versions (overwrite/upsert)."""
from pyspark.sql import functions as F

from tickwise.operators.history import hist_ratio_query, ratio_query
from tickwise.plans import fixtures as X
from tickwise.plans.jobs import one_row_per_key, read_history, run_batch_ratio_job
from tickwise.session import new_path

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_runs_append_delta_and_history(spark):
    ticks = X.minute_ticks(spark, SF)
    raw, trans, hist = new_path(spark, "raw"), new_path(spark, "trans"), new_path(spark, "hist")
    day1 = F.col("timestampvalue") < F.lit("2024-01-16")
    ticks.where(day1).write.parquet(raw)
    run_batch_ratio_job(spark, raw, trans, hist, 3, width=5, run_id=1)
    ticks.where(~day1).write.mode("append").parquet(raw)
    run_batch_ratio_job(spark, raw, trans, hist, 3, width=5, run_id=2)

    first = ratio_query(ticks.where(day1), None, 3)
    second = ratio_query(ticks, first, 3)
    assert _same(spark.read.parquet(trans), first.unionByName(second))
    want = hist_ratio_query(first.unionByName(second), 5)
    got = read_history(spark, hist)
    assert _same(got, one_row_per_key(want))
    assert got.groupBy("symbol", "timestampvalue").count().where("count > 1").count() == 0
    # the kept rows are rows of the faithful result
    assert got.exceptAll(want).count() == 0


def test_history_upsert_keeps_old_keys(spark):
    ticks = X.ticks(spark, SF)
    raw, trans, hist = new_path(spark, "raw"), new_path(spark, "trans"), new_path(spark, "hist")
    ticks.where(F.col("symbol") == "click").write.parquet(raw)
    run_batch_ratio_job(spark, raw, trans, hist, 3, run_id=1, upsert=True, rounded=False)
    n1 = read_history(spark, hist).count()
    ticks.where(F.col("symbol") == "view").write.mode("append").parquet(raw)
    run_batch_ratio_job(spark, raw, trans, hist, 3, run_id=2, upsert=True, rounded=False)
    h = read_history(spark, hist)
    assert h.where(F.col("symbol") == "click").count() == n1
    assert h.where(F.col("symbol") == "view").count() > 0
    assert h.groupBy("symbol", "timestampvalue").count().where("count > 1").count() == 0


def test_bucketed_job_matches_and_anti_join_has_no_shuffle(spark):
    from tickwise.operators.history import delta_anti_join
    from tickwise.plans.jobs import create_bucketed_tables, run_bucketed_ratio_job
    loc = new_path(spark, "tables")
    spark.sql("create database if not exists tw_test")
    tt, tr = "tw_test.ticks_b", "tw_test.trans_b"
    create_bucketed_tables(spark, tt, tr, 4, loc)
    ticks = X.minute_ticks(spark, SF)
    day1 = F.col("timestampvalue") < F.lit("2024-01-16")
    from tickwise.sources.sinks import write_batch_to_table
    write_batch_to_table(ticks.where(day1), tt, 0)
    write_batch_to_table(ticks.where(day1), tt, 0)          # a replayed batch: no duplicates
    hist = new_path(spark, "hist")
    run_bucketed_ratio_job(spark, tt, tr, hist, 3, width=5, run_id=1)
    write_batch_to_table(ticks.where(~day1), tt, 1)
    run_bucketed_ratio_job(spark, tt, tr, hist, 3, width=5, run_id=2)
    assert spark.table(tt).count() == ticks.count()

    first = ratio_query(ticks.where(day1), None, 3)
    second = ratio_query(ticks, first, 3)
    assert _same(spark.table(tr), first.unionByName(second))
    assert _same(read_history(spark, hist), one_row_per_key(hist_ratio_query(first.unionByName(second), 5)))

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = delta_anti_join(spark.table(tt), spark.table(tr))._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_partitioned_transformed_table(spark):
    ticks = X.ticks(spark, SF)
    raw, trans, hist = new_path(spark, "raw"), new_path(spark, "trans"), new_path(spark, "hist")
    ticks.write.parquet(raw)
    run_batch_ratio_job(spark, raw, trans, hist, 3, run_id=1, partitioned=True)
    import glob
    from tickwise.session import local_path
    assert glob.glob(local_path(trans) + "/symbol=*")
    got = spark.read.parquet(trans).select("symbol", "timestampvalue", "avgprice", "pricechange",
                                           "avgvol", "volumechange", "ratio")
    assert _same(got, ratio_query(ticks, None, 3))
