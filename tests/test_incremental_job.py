"""The delta index, the incremental batch job and the bucket upsert."""
import glob
import os

from pyspark.sql import functions as F

from tickwise.operators.delta_index import delta_by_index, form_of, index_rows, number_of, read_index
from tickwise.operators.history import TRANSFORMED_COLS, delta_anti_join, hist_ratio_query, ratio_query
from tickwise.plans import fixtures as X
from tickwise.plans.jobs import RunState, one_row_per_key, read_history, run_incremental_ratio_job
from tickwise.session import local_path, new_path
from tickwise.sources.sinks import append_partitioned_by_symbol, upsert_buckets

SF = "/root/testdata/sf0.001"
TEXTS = ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-01 00:00", "2024-01-01 00:01", "2024-01-01 24:00:00",
         "2024-02-30 10:00:00", "2024-02-29 23:59:59", "1969-12-31 23:59:59", "1970-01-01 00:00:00", "1970-01-01 00:00",
         "0001-01-01 00:00:00", "9999-12-31 23:59:59", "2024-01-01 09:06:07", "2024-01-01 09:06:07.5", "2024-01-01", "",
         " 2024-01-01 00:00:00", "\"2024-01-01 00:00:00\"", "Invalid", "2024-03-31 02:30:00", "2024-03-31 03:30:00", None]


def _same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _ticks(spark, texts):
    return spark.createDataFrame([("a", t, 1.0, 1, i) for i, t in enumerate(texts)],
                                 "symbol string, timestampvalue string, price double, volume int, tick_id long")


def test_index_is_exact_for_every_text(spark):
    ticks = _ticks(spark, TEXTS)
    for k in range(len(TEXTS)):
        done = _ticks(spark, TEXTS[k::3] + TEXTS[k::3])
        got = delta_by_index(ticks, index_rows(done))
        assert _same(got, delta_anti_join(ticks, done)), TEXTS[k]
        if k > 3:
            break
    none = delta_by_index(ticks, index_rows(ticks.limit(0)))
    assert got.columns == ticks.columns and _same(none, ticks)
    assert delta_by_index(ticks.limit(0), index_rows(ticks)).count() == 0


def test_numbers_are_one_to_one_in_any_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")       # 02:30 of that day is not there
    try:
        t = _ticks(spark, TEXTS).select("timestampvalue", form_of(F.col("timestampvalue")).alias("form"),
                                        number_of(F.col("timestampvalue")).alias("n")).where("form is not null").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    usual = {r.timestampvalue for r in t}
    assert {"2024-03-31 02:30:00", "2024-03-31 03:30:00", "1969-12-31 23:59:59", "2024-01-01 00:00"} <= usual
    assert not usual & {"2024-02-30 10:00:00", "2024-01-01 24:00:00", "", "Invalid", "2024-01-01 09:06:07.5"}
    assert len({(r.form, r.n) for r in t}) == len(t)


def test_union_of_several_runs(spark):
    ticks, paths = _ticks(spark, TEXTS), []
    for part in (TEXTS[:5], TEXTS[3:9], TEXTS[12:14], []):
        paths.append(new_path(spark, "index"))
        index_rows(_ticks(spark, part)).write.parquet(paths[-1])
    done = _ticks(spark, TEXTS[:9] + TEXTS[12:14])
    assert _same(delta_by_index(ticks, read_index(spark, paths)), delta_anti_join(ticks, done))
    assert _same(delta_by_index(ticks, read_index(spark, [])), ticks)


def test_history_is_not_shuffled(spark):
    raw, index = new_path(spark, "raw"), new_path(spark, "index")
    X.ticks(spark, SF).write.parquet(raw)
    index_rows(X.ticks(spark, SF).where("symbol <> 'view'")).write.parquet(index)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # only what the operator itself broadcasts
    try:
        usual = spark.read.parquet(raw).where(form_of(F.col("timestampvalue")).isNotNull())
        delta = delta_by_index(usual, spark.read.parquet(index))
        plan = delta._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    formed = plan.split("Union", 1)[1].split("left_anti", 1)[0].split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in formed and "hashpartitioning" not in formed


def test_job_makes_its_state_anew_where_a_run_failed(spark):
    raw, trans, hist, state = (new_path(spark, x) for x in ("raw", "trans", "hist", "state"))
    ticks = X.mixed_ticks(spark, SF)
    parts = [F.col("tick_id") % 3 == k for k in range(3)]
    want, done = None, None
    for run, part in enumerate(parts):
        ticks.where(part).write.mode("append").parquet(raw)
        all_ticks = spark.read.parquet(raw)
        new = ratio_query(all_ticks, done, 3) if done is not None else ratio_query(all_ticks, None, 3)
        rows = spark.createDataFrame(new.collect(), new.schema)
        want = rows if want is None else want.unionByName(rows)
        done = want
        if run == 1:        # this run ends after its append: no state is left behind
            run_incremental_ratio_job(spark, raw, trans, hist, new_path(spark, "lost"), 3, width=5, run_id=run)
        else:
            run_incremental_ratio_job(spark, raw, trans, hist, state, 3, width=5, run_id=run)
    got = spark.read.parquet(trans).select(*TRANSFORMED_COLS)
    assert _same(got, want)
    keys = ["symbol", "timestampvalue", "histratio"]
    assert _same(read_history(spark, hist).select(*keys), one_row_per_key(hist_ratio_query(want, 5)).select(*keys))
    runs = RunState(spark, state)
    assert runs.valid_runs() == [0, 2] and runs.fits(2, spark.read.parquet(trans)) and not runs.fits(0, spark.read.parquet(trans))


def test_job_without_new_ticks_changes_nothing(spark):
    raw, trans, hist, state = (new_path(spark, x) for x in ("raw", "trans", "hist", "state"))
    X.mixed_ticks(spark, SF).write.parquet(raw)
    run_incremental_ratio_job(spark, raw, trans, hist, state, 3, width=5, run_id=1)
    first = [spark.read.parquet(trans).count(), sorted(read_history(spark, hist).collect())]
    run_incremental_ratio_job(spark, raw, trans, hist, state, 3, width=5, run_id=2)
    assert [spark.read.parquet(trans).count(), sorted(read_history(spark, hist).collect())] == first


def _files(path):
    return {os.path.relpath(f, local_path(path)) for f in glob.glob(local_path(path) + "/bucket=*/*.parquet")}


def test_upsert_writes_only_changed_buckets(spark):
    path = new_path(spark, "upsert")
    keyed = lambda rows: spark.createDataFrame(rows, "symbol string, timestampvalue string, ratio double, s long")
    first = [("a", str(k), float(k), 0) for k in range(300)] + [(None, None, 1.0, 0), (None, "x", 2.0, 0)]
    upsert_buckets(keyed(first), path, 64, seq="s")
    before = _files(path)
    second = [("a", "7", -1.0, 1), ("a", "7", -2.0, 2), ("b", "7", 5.0, 0), (None, None, 9.0, 0)]
    changed = upsert_buckets(keyed(second), path, 64, seq="s")
    after = _files(path)
    assert 1 <= len(changed) <= 3
    assert {f.split("/")[0] for f in before ^ after} == {f"bucket={b}" for b in changed}
    want = {(r[0], r[1]): r[2] for r in first} | {("a", "7"): -2.0, ("b", "7"): 5.0, (None, None): 9.0}
    rows = spark.read.parquet(path).select("symbol", "timestampvalue", "ratio").collect()
    assert len(rows) == len(want) and {(r[0], r[1]): r[2] for r in rows} == want
    assert upsert_buckets(keyed([]), path, 64, seq="s") == [] and _files(path) == after


def test_partitioned_append_writes_few_files_per_symbol(spark):
    path = new_path(spark, "by-symbol")
    rows = spark.range(0, 40_000, 1, 16).select((F.col("id") % 500).cast("string").alias("symbol"), F.col("id").alias("v"))
    append_partitioned_by_symbol(rows, path)
    files = glob.glob(local_path(path) + "/symbol=*/*.parquet")
    assert len(files) <= 2 * 500 and spark.read.parquet(path).count() == 40_000
