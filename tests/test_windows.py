"""W1 row window: the chunked (skew-safe) plan equals the plain per-symbol
window and a brute-force deque, for any chunking, ties, NULLs and short chunks."""
from collections import deque

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickwise.operators.windows import moving_avg_rows, running_first_last


def brute(rows, n):
    """Per symbol, in (ts, id) order (NULL ts first): mean of the last n."""
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for sym, rs in by.items():
        rs.sort(key=lambda r: ((r[1] is not None), r[1] or "", r[4]))
        dp, dv = deque(maxlen=n), deque(maxlen=n)
        for r in rs:
            dp.append(r[2]); dv.append(float(r[3]))
            sp = 0.0
            for x in dp:
                sp += x
            sv = 0.0
            for x in dv:
                sv += x
            out[r[4]] = (sp / len(dp), sv / len(dv))
    return out


def run(df, n, **kw):
    return {r.tick_id: (r.avgprice, r.avgvolume)
            for r in moving_avg_rows(df, n, **kw).collect()}


ROWS = [
    ("A", "2024-01-01 00:00:01", 10.0, 1, 1), ("A", "2024-01-01 00:00:02", 11.0, 2, 2),
    ("A", "2024-01-01 01:00:00", 12.0, 3, 3), ("A", "2024-01-01 03:00:00", 13.0, 4, 4),
    ("A", "2024-01-02 00:00:00", 14.0, 5, 5), ("B", "2024-01-01 00:00:01", 1.0, 0, 6),
    ("B", "2024-01-01 00:00:01", 2.0, 0, 7), ("A", None, 9.0, 9, 8),
]


def test_chunked_equals_plain_and_brute(make_ticks):
    df = make_ticks(ROWS)
    for n in (1, 2, 3, 5):
        want = brute(ROWS, n)
        assert run(df, n, split=False) == want
        for chars in (4, 10, 13, 19):
            assert run(df, n, split=True, chunk_chars=chars) == want, (n, chars)
        assert run(df, n, hot_rows=1) == want


def test_short_chunks_carry_across_several_chunks(make_ticks):
    # one tick per hour: every chunk is shorter than n-1, so carries span chunks
    rows = [("S", f"2024-01-01 {h:02d}:00:00", float(h), h, h) for h in range(24)]
    df = make_ticks(rows)
    assert run(df, 6, split=True) == brute(rows, 6)


def test_hot_symbol_many_chunks(make_ticks):
    rows = [("HOT", f"2024-01-{1 + i // 500:02d} {(i // 30) % 24:02d}:{i % 60:02d}:00",
             float(i % 97), i % 7, i) for i in range(3000)]
    rows += [(f"c{i}", "2024-01-01 00:00:00", 1.0, 1, 10_000 + i) for i in range(50)]
    df = make_ticks(rows)
    assert run(df, 4, hot_rows=100) == brute(rows, 4)   # auto: HOT is split, the rest is not
    assert run(df, 4, split=True) == brute(rows, 4)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40),
                          st.integers(1, 500), st.integers(0, 9)), min_size=1, max_size=60),
       st.integers(1, 5), st.sampled_from([12, 13, 16]))
def test_property_random_ticks(spark, rows, n, chars):
    ticks = [(s, f"2024-01-01 {t // 10:02d}:{t % 10:02d}:00", p / 100, v, i)
             for i, (s, t, p, v) in enumerate(rows)]
    df = spark.createDataFrame(ticks, "symbol string, timestampvalue string, price double, "
                                      "volume int, tick_id long")
    assert run(df, n, split=True, chunk_chars=chars) == brute(ticks, n)
    assert run(df, n, hot_rows=1) == brute(ticks, n)


def widths(df, target, time_col="timestampvalue"):
    from tickwise.operators.windows import hot_keys
    hot = hot_keys(df, "symbol", time_col, "tick_id", target)
    return {} if hot is None else {r[0]: (r[1], r[2]) for r in hot.collect()}


def test_hot_key_detection(make_ticks):
    rows = [("HOT", f"2024-01-{1 + i // 100:02d} 00:{i % 60:02d}:00", 1.0, 1, i) for i in range(2000)]
    rows += [(f"c{i}", "2024-01-01 00:00:00", 1.0, 1, 10_000 + i) for i in range(100)]
    df = make_ticks(rows)
    assert widths(df, 3000) == {}
    assert {k: w for k, (w, _) in widths(df, 150).items()} == {"HOT": 10}      # a day holds 100
    assert {k: w for k, (w, _) in widths(df, 50).items()} == {"HOT": 16}       # a minute holds 2
    assert widths(df, 1)["HOT"][0] == 99                                       # not even a second is small enough
    assert widths(df, 50, None)["HOT"] == (0, 50)                              # arrival order: ranges of tick_id


def largest_chunk(df, n, **kw):
    from tickwise.operators.windows import CHUNK
    got = moving_avg_rows(df, n, keep_chunk=True, **kw)
    return got.groupBy("symbol", CHUNK).count().agg({"count": "max"}).first()[0]


def test_burst_in_one_second_null_symbol_and_quotes_are_split(make_ticks):
    burst = [("HOT", "2024-01-01 09:00:00", float(i % 7), 1, i) for i in range(600)]
    burst += [("HOT", f"2024-01-{d:02d} 09:00:00", 1.0, 1, 1000 + d) for d in range(2, 29)]
    none = [(None, f"2024-01-01 09:{i // 60:02d}:{i % 60:02d}", float(i % 5), 2, 5000 + i) for i in range(600)]
    df = make_ticks(burst + none)
    want = brute(burst + none, 3)
    assert run(df, 3, hot_rows=100) == want
    assert largest_chunk(df, 3, hot_rows=100) <= 110
    quoted = df.withColumn("timestampvalue", F.concat(F.lit('"'), "timestampvalue", F.lit('"')))
    assert run(quoted, 3, hot_rows=100) == want
    assert largest_chunk(quoted, 3, hot_rows=100) <= 110


def test_window_longer_than_the_chunks(make_ticks):
    rows = [("S", f"2024-01-01 {i // 20 // 60:02d}:{i // 20 % 60:02d}:{i % 20:02d}", float(i % 11), i % 3, i)
            for i in range(1200)]
    df = make_ticks(rows)
    assert run(df, 200, hot_rows=25) == brute(rows, 200)
    assert run(df, 200) == brute(rows, 200)


def test_arrival_order_window_is_split_by_tick_id(make_ticks):
    import random
    rows = [("S", f"2024-01-01 00:00:{random.Random(i).randint(0, 59):02d}", float(i), i, i) for i in range(500)]
    df = make_ticks(rows)
    got = {r.tick_id: (r.avgprice, r.avgvolume)
           for r in moving_avg_rows(df, 4, order=("tick_id",), hot_rows=60).collect()}
    want = {i: (sum(range(max(0, i - 3), i + 1)) / min(4, i + 1),) * 2 for i in range(500)}
    assert got == want
    assert largest_chunk(df, 4, order=("tick_id",), hot_rows=60) <= 60


def test_plan_shuffles_by_symbol_and_chunk(make_ticks):
    df = moving_avg_rows(make_ticks(ROWS), 3, split=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan          # partial top-k before the shuffle
    assert "_tw_chunk" in plan


def test_running_first_last(make_ticks):
    df = make_ticks(ROWS[:5]).where(F.col("symbol") == "A")
    rows = running_first_last(df).orderBy("timestampvalue").collect()
    assert {r.first_ts for r in rows} == {"2024-01-01 00:00:01"}
    assert [r.last_ts for r in rows] == [r.timestampvalue for r in rows]
