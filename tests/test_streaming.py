"""Stream = batch: the keyed-state count window (W2) replayed from files in
one or many micro-batches and across a restart equals the batch window (W1);
the ingest, realtime alert and feed jobs end to end."""
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tickwise.operators.alerts import ALERT_COLS, realtime_ratio
from tickwise.plans import fixtures as X
from tickwise.session import local_path, new_path
from tickwise.sources.streams import message_file_stream, stage_message_files
from tickwise.sources.ticks import tick_messages
from tickwise.streaming import feeds as SF
from tickwise.streaming.ingest import start_ingest
from tickwise.streaming.realtime import BY_TIME, realtime_stream, start_metrics_sink, start_realtime_alerts

SF001 = "/root/testdata/sf0.001"


def _ticks(spark):
    return X.ticks(spark, SF001)


def _expected(spark):
    return {r.tick_id: r for r in realtime_ratio(_ticks(spark), 3).collect()}


def _run(spark, src, ckpt, out, files):
    q = start_metrics_sink(realtime_stream(message_file_stream(spark, src, max_files_per_trigger=files), 3),
                           out, ckpt)
    q.awaitTermination()
    assert q.exception() is None
    return q


@pytest.mark.parametrize("slices", [1, 7])
def test_stream_equals_batch(spark, slices):
    src, out, ckpt = new_path(spark, "src"), new_path(spark, "out"), new_path(spark, "ckpt")
    stage_message_files(tick_messages(_ticks(spark)), src, slices, files_per_slice=2)
    q = _run(spark, src, ckpt, out, 2)
    assert len(q.recentProgress) >= slices
    got = {r.tick_id: r for r in spark.read.parquet(out).collect()}
    want = _expected(spark)
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k].asDict() == w.asDict(), k


def test_stream_restart_keeps_state(spark):
    msgs = tick_messages(_ticks(spark))
    src, out, ckpt = new_path(spark, "src"), new_path(spark, "out"), new_path(spark, "ckpt")
    mid = msgs.agg(F.percentile_approx("offset", 0.5)).first()[0]
    stage_message_files(msgs.where(F.col("offset") <= mid), src, 3, files_per_slice=1)
    _run(spark, src, ckpt, out, 1)
    stage_message_files(msgs.where(F.col("offset") > mid), src, 3, files_per_slice=1)
    _run(spark, src, ckpt, out, 1)                       # restart from the checkpoint
    got = {r.tick_id: r.asDict() for r in spark.read.parquet(out).collect()}
    want = {k: v.asDict() for k, v in _expected(spark).items()}
    assert got == want


def test_ingest_strict_and_empty(spark):
    src, tgt, ckpt = new_path(spark, "ing-src"), new_path(spark, "ing-tgt"), new_path(spark, "ing-ckpt")
    msgs = tick_messages(_ticks(spark))
    stage_message_files(msgs, src, 2, files_per_slice=1)
    q = start_ingest(message_file_stream(spark, src, max_files_per_trigger=1), tgt, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    t = spark.read.parquet(tgt)
    assert t.count() == msgs.count()
    assert set(t.columns) >= {"symbol", "timestampvalue", "price", "volume", "batch_id"}


def test_alert_job_and_feeds(spark):
    live = X.live_ticks(spark, SF001)
    src = new_path(spark, "q4-src")
    stage_message_files(tick_messages(live), src, 3, files_per_slice=1)
    stock, alerts = new_path(spark, "stock"), new_path(spark, "alerts")
    q = start_realtime_alerts(spark, message_file_stream(spark, src, max_files_per_trigger=1), 3, X.THRESHOLD, stock, alerts,
                              new_path(spark, "q4-ckpt"), hist=X.history(spark, SF001), width=5)
    q.awaitTermination()
    assert q.exception() is None
    want = X.live_alerts(spark, SF001).select(*ALERT_COLS)
    got = spark.read.parquet(alerts).select(*ALERT_COLS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    out = new_path(spark, "feed-out")
    os.makedirs(local_path(out), exist_ok=True)

    def writer(payload, _dir=local_path(out)):
        import uuid
        with open(os.path.join(_dir, uuid.uuid4().hex + ".json"), "w") as fh:
            fh.write(payload)

    fq = SF.start_dashboard_feed(spark, stock, alerts, new_path(spark, "feed-ckpt"), writer)
    fq.awaitTermination()
    rows = [r for f in glob.glob(os.path.join(local_path(out), "*.json")) for r in json.load(open(f))]
    assert len(rows) == spark.read.parquet(stock).count()
    assert sum(r["alertFlag"] for r in rows) == got.count()
    assert list(rows[0].keys()) == list(__import__("tickwise.operators.feeds", fromlist=["x"]).DASHBOARD_COLUMNS)

    out2 = new_path(spark, "pivot-out")
    os.makedirs(local_path(out2), exist_ok=True)

    def writer2(payload, _dir=local_path(out2)):
        import uuid
        with open(os.path.join(_dir, uuid.uuid4().hex + ".json"), "w") as fh:
            fh.write(payload)

    cq = SF.start_count_feeds(spark, alerts, new_path(spark, "cnt-ckpt"), writer2,
                              symbols=("click", "view", "HDFC"))
    cq.awaitTermination()
    assert cq.exception() is None
    from tickwise.operators.feeds import alert_pivot_feed
    pivots = [r for f in glob.glob(os.path.join(local_path(out2), "*.json")) for r in json.load(open(f))]
    want = alert_pivot_feed(spark.read.parquet(alerts), ("click", "view", "HDFC")).first().asDict()
    assert pivots[-1] == {k: (None if v is None else str(v)) for k, v in want.items()}


def test_wide_store_sink_equals_batch(spark):
    from tickwise.operators.alerts import realtime_ratio, wide_store_rows
    from tickwise.streaming.realtime import read_wide_store, start_wide_store_sink
    src, out = new_path(spark, "ws-src"), new_path(spark, "ws-out")
    stage_message_files(tick_messages(_ticks(spark)), src, 4, files_per_slice=1)
    q = start_wide_store_sink(spark, realtime_stream(message_file_stream(spark, src, max_files_per_trigger=1), 3,
                                                     rounded=False), out, new_path(spark, "ws-ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    got = read_wide_store(spark, out)
    want = wide_store_rows(realtime_ratio(_ticks(spark), 3, rounded=False))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("task_size", [None, "2k"])
def test_state_table_window_equals_batch_and_restarts(spark, task_size):
    """Skew-safe W2 (state table per micro-batch): equal to the batch window,
    with hot symbols split inside each micro-batch (tiny task size) and across
    a restart from the checkpoint."""
    from tickwise.operators.windows import moving_avg_rows
    from tickwise.streaming.count_window import start_count_window_batches
    from tickwise.streaming.realtime import parsed_ticks
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if task_size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", task_size)
    try:
        msgs = tick_messages(_ticks(spark))
        src, out = new_path(spark, "sw-src"), new_path(spark, "sw-out")
        state, ckpt = new_path(spark, "sw-state"), new_path(spark, "sw-ckpt")
        mid = msgs.agg(F.percentile_approx("offset", 0.5)).first()[0]
        stage_message_files(msgs.where(F.col("offset") <= mid), src, 2, files_per_slice=1)
        for run in range(2):
            if run == 1:      # more input, then a restart from the same checkpoint
                stage_message_files(msgs.where(F.col("offset") > mid), src, 2, files_per_slice=1)
            q = start_count_window_batches(parsed_ticks(message_file_stream(spark, src, max_files_per_trigger=1)),
                                           3, out, state, ckpt)
            q.awaitTermination()
            assert q.exception() is None
        got = spark.read.parquet(out).select("tick_id", "priceavg", "volumeavg")
        parsed = parsed_ticks(msgs)
        want = moving_avg_rows(parsed, 3, outputs=("priceavg", "volumeavg"), split=False).select(
            "tick_id", "priceavg", "volumeavg")
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ingest_into_bucketed_table(spark):
    from tickwise.plans.jobs import create_bucketed_tables
    spark.sql("create database if not exists tw_ing")
    create_bucketed_tables(spark, "tw_ing.ticks", "tw_ing.trans", 4, new_path(spark, "ing-tables"))
    src, ckpt = new_path(spark, "ingt-src"), new_path(spark, "ingt-ckpt")
    msgs = tick_messages(_ticks(spark))
    stage_message_files(msgs, src, 2, files_per_slice=1)
    q = start_ingest(message_file_stream(spark, src, max_files_per_trigger=1), "tw_ing.ticks", ckpt,
                     trigger={"availableNow": True}, table=True)
    q.awaitTermination()
    assert q.exception() is None
    assert spark.table("tw_ing.ticks").count() == msgs.count()


@pytest.mark.parametrize("slices", [1, 3, 10])
def test_out_of_order_ticks_do_not_depend_on_micro_batches(spark, slices):
    from tickwise.operators.windows import moving_avg_rows
    from tickwise.streaming.count_window import count_window_stream, start_count_window_batches
    from tickwise.streaming.realtime import parsed_ticks
    msgs = tick_messages(X.scrambled_ticks(spark, SF001))
    want = moving_avg_rows(parsed_ticks(msgs), 3, order=("tick_id",), outputs=("priceavg", "volumeavg"),
                           split=False).select("tick_id", "priceavg", "volumeavg")
    src, out = new_path(spark, "oo-src"), new_path(spark, "oo-out")
    files = stage_message_files(msgs, src, slices)
    stream = lambda: parsed_ticks(message_file_stream(spark, src, max_files_per_trigger=files))
    q = start_metrics_sink(count_window_stream(stream(), 3), out, new_path(spark, "oo-ckpt"), state_partitions=2)
    q.awaitTermination()
    out2, state = new_path(spark, "oo-out"), new_path(spark, "oo-state")
    q = start_count_window_batches(stream(), 3, out2, state, new_path(spark, "oo-ckpt"))
    q.awaitTermination()
    for path in (out, out2):
        got = spark.read.parquet(path).select("tick_id", "priceavg", "volumeavg")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert len(os.listdir(local_path(state))) <= 2          # old state versions are deleted


def test_wide_store_micro_batches_write_only_their_rows(spark):
    from tickwise.streaming.realtime import compact_wide_store, read_wide_store, start_wide_store_sink
    schema = ("symbol string, timestampvalue string, price double, volume double, priceavg double, pricechange double, "
              "volumeavg double, volumechange double, ratio double, tick_id long")
    src, out = new_path(spark, "wsb-src"), new_path(spark, "wsb-out")
    for i in range(10):
        spark.createDataFrame([(f"S{i % 3}", "2024-01-01 09:00:00", *[float(i)] * 7, i)], schema).coalesce(1) \
            .write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_wide_store_sink(spark, stream, out, new_path(spark, "wsb-ckpt"))
    q.awaitTermination()
    assert spark.read.parquet(out).groupBy("batch_id").count().agg(F.max("count")).first()[0] == 1
    rows = {r.symbol: r.ratio for r in read_wide_store(spark, out).collect()}
    assert rows == {"S0": 9.0, "S1": 7.0, "S2": 8.0}
    small = compact_wide_store(spark, out, new_path(spark, "wsb-compact"))
    assert {r.symbol: r.ratio for r in read_wide_store(spark, small).collect()} == rows


def test_text_source_alert_feed_and_digest_streams(spark):
    """JSON lines as a text stream feed the realtime job; the alert feed and
    the mail digest streams deliver one payload/text per new alert."""
    from tickwise.sources.streams import text_line_stream
    live = X.live_ticks(spark, SF001)
    src = new_path(spark, "txt-src")
    tick_messages(live).select("value").coalesce(1).write.text(src)
    stock, alerts = new_path(spark, "t-stock"), new_path(spark, "t-alerts")
    q = start_realtime_alerts(spark, text_line_stream(spark, src), 3, X.THRESHOLD, stock, alerts,
                              new_path(spark, "t-ckpt"), hist=X.history(spark, SF001), width=5,
                              state_partitions=2, order=BY_TIME)
    q.awaitTermination()
    assert q.exception() is None
    want = X.live_alerts(spark, SF001).select(*ALERT_COLS)
    got = spark.read.parquet(alerts).select(*ALERT_COLS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    for start, name in ((SF.start_alert_feed, "af"), (SF.start_alert_digest, "dg")):
        out = new_path(spark, f"{name}-out")
        os.makedirs(local_path(out), exist_ok=True)

        def writer(payload, _dir=local_path(out)):
            import uuid
            with open(os.path.join(_dir, uuid.uuid4().hex + ".txt"), "w") as fh:
                fh.write(payload)

        fq = start(spark, alerts, new_path(spark, f"{name}-ckpt"), writer)
        fq.awaitTermination()
        assert fq.exception() is None
        texts = [open(f).read() for f in glob.glob(os.path.join(local_path(out), "*.txt"))]
        if name == "af":
            rows = [r for t in texts for r in json.loads(t)]
            assert len(rows) == want.count() and all(r["Alert"] == 1 for r in rows)
        else:
            assert len(texts) == want.count()
            assert all(t.startswith("STOCK PRICE ALERTS from ") and "\nSymbol = " in t for t in texts)


def test_end_to_end_chain(spark):
    """ingest -> batch ratio job -> realtime alerts (fresh history lookup,
    state-table window) -> dashboard feed, against the batch operators."""
    from tickwise.operators.alerts import ratio_alerts
    from tickwise.plans.jobs import read_history, run_batch_ratio_job
    before = X.ticks_from_events(X.events_before(spark, SF001, True))
    live = X.live_ticks(spark, SF001)
    raw, trans, hist = new_path(spark, "e2e-raw"), new_path(spark, "e2e-trans"), new_path(spark, "e2e-hist")
    src = new_path(spark, "e2e-src")
    stage_message_files(tick_messages(before), src, 2, files_per_slice=1)
    q = start_ingest(message_file_stream(spark, src, max_files_per_trigger=1), raw,
                     new_path(spark, "e2e-ing"), trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    run_batch_ratio_job(spark, raw, trans, hist, 3, width=5, run_id=1)

    live_src = new_path(spark, "e2e-live")
    stage_message_files(tick_messages(live), live_src, 3, files_per_slice=1)
    stock, alerts = new_path(spark, "e2e-stock"), new_path(spark, "e2e-alerts")
    q = start_realtime_alerts(spark, message_file_stream(spark, live_src, max_files_per_trigger=1), 3,
                              X.THRESHOLD, stock, alerts, new_path(spark, "e2e-rt"), hist_path=hist,
                              width=5, state_path=new_path(spark, "e2e-state"))
    q.awaitTermination()
    assert q.exception() is None
    want = ratio_alerts(live, read_history(spark, hist), 3, X.THRESHOLD, width=5).select(*ALERT_COLS)
    got = spark.read.parquet(alerts).select(*ALERT_COLS)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    out = new_path(spark, "e2e-feed")
    os.makedirs(local_path(out), exist_ok=True)

    def writer(payload, _dir=local_path(out)):
        import uuid
        with open(os.path.join(_dir, uuid.uuid4().hex + ".json"), "w") as fh:
            fh.write(payload)

    fq = SF.start_dashboard_feed(spark, stock, alerts, new_path(spark, "e2e-fck"), writer)
    fq.awaitTermination()
    rows = [r for f in glob.glob(os.path.join(local_path(out), "*.json")) for r in json.load(open(f))]
    assert len(rows) == spark.read.parquet(stock).count()
    assert sum(r["alertFlag"] for r in rows) == got.count()
