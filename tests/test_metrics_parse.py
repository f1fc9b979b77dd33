"""Zero divisors (D1), NaN handling (D2), bad JSON ticks."""
import math

import pytest

from tickwise.operators.alerts import realtime_ratio
from tickwise.operators.history import ratio_query
from tickwise.operators.parse import clean_ticks, drop_invalid, parse_tick_lenient, parse_tick_strict


def test_zero_volumes_batch_and_stream(make_ticks):
    # Volumes 0,0,0 -> volumechange 0/0
    rows = [("Z", f"2024-01-01 00:00:0{i}", 10.0 + i, 0, i) for i in range(3)]
    df = make_ticks(rows)
    b = {r.timestampvalue: r for r in ratio_query(df, None, 3).collect()}
    assert all(r.volumechange is None and r.ratio == 0.0 for r in b.values())
    s = {r.timestampvalue: r for r in realtime_ratio(df, 3, rounded=False).collect()}
    assert all(r.volumechange == 0.0 and r.ratio == 0.0 for r in s.values())   # NaN -> 0


def test_flat_volume_moving_price(make_ticks):
    # x/0: +Infinity in the stream, 0 in batch
    rows = [("F", "2024-01-01 00:00:00", 10.0, 5, 0), ("F", "2024-01-01 00:00:01", 12.0, 5, 1)]
    df = make_ticks(rows)
    s = realtime_ratio(df, 2, rounded=True).orderBy("tick_id").collect()
    assert s[0].ratio == 0.0                      # 0/0 (first tick: price = avg)
    assert s[1].ratio == math.inf and s[1].volumechange == 0.0
    b = ratio_query(df, None, 2).orderBy("timestampvalue").collect()
    assert b[1].ratio == 0.0 and b[1].volumechange == 0.0 and b[1].pricechange > 0


def test_falling_price_flat_volume_is_minus_inf(make_ticks):
    rows = [("F", "2024-01-01 00:00:00", 10.0, 5, 0), ("F", "2024-01-01 00:00:01", 8.0, 5, 1)]
    s = realtime_ratio(make_ticks(rows), 2).orderBy("tick_id").collect()
    assert s[1].ratio == -math.inf


def test_rounding_half_up_5(make_ticks):
    rows = [("R", "2024-01-01 00:00:00", 2.000005, 1, 0)]
    s = realtime_ratio(make_ticks(rows), 1, rounded=True).collect()
    assert s[0].price == 2.00001


BAD = [
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:01","price":12.5,"volume":3}', 1),
    ('{"symbol":"A","timestamp', 2),                                              # truncated
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:02","volume":3}', 3),      # no price
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:03","price":null,"volume":3}', 4),
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:04","price":"12.5","volume":3}', 5),
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:05","price":"abc","volume":3}', 6),
    ('{"symbol":null,"timestampValue":"2024-01-01 00:00:06","price":1,"volume":3}', 7),
    ('{"symbol":"InvalidCo","timestampValue":"2024-01-01 00:00:07","price":1,"volume":3}', 8),
    ('{"symbol":"A","timestampValue":"2024-01-01 00:00:08","price":1,"volume":3,"x":[1]}', 9),
    ('{"symbol":"A","price":1,"timestampValue":"2024-01-01 00:00:09","price":2.5,"volume":"4","symbol":"B"}', 10),
    ('{"symbol":"A","symbol":"B","price":1,"volume":3}', 11),                     # repeated key, no time
    ('[1, 2]', 12), ('7', 13), (None, 14), ('', 15),
]


def test_lenient_parse_cases(spark):
    df = spark.createDataFrame(BAD, "value string, offset long")
    got = {r.offset: (r.symbol, r.timestampvalue, r.price, r.volume)
           for r in parse_tick_lenient(df, keep=("offset",)).collect()}
    assert got[1] == ('"A"', '"2024-01-01 00:00:01"', 12.5, 3.0)
    assert got[2] == ("Invalid", "Invalid", 0.0, 0.0)
    assert got[3] == ("Invalid", "Invalid", 0.0, 0.0)
    assert got[4][2] == 0.0 and got[4][0] == '"A"'
    assert got[5][2] == 12.5
    assert got[6][2] == 0.0
    assert got[7][0] == "null"
    assert got[8][0] == '"InvalidCo"'
    assert got[9][:3] == ('"A"', '"2024-01-01 00:00:08"', 1.0)
    assert got[10] == ('"B"', '"2024-01-01 00:00:09"', 2.5, 4.0)             # the last of a repeated key
    assert all(got[i] == ("Invalid", "Invalid", 0.0, 0.0) for i in (11, 12, 13, 14, 15))
    kept = drop_invalid(parse_tick_lenient(df, keep=("offset",)))
    assert sorted(r.offset for r in kept.collect()) == [1, 4, 5, 6, 7, 9, 10]
    cleaned = {r.offset: r for r in clean_ticks(kept).collect()}
    assert cleaned[1].symbol == "A" and cleaned[1].timestampvalue == "2024-01-01 00:00:01"


def test_strict_parse_ok_and_fails(spark):
    ok = spark.createDataFrame([BAD[0]], "value string, offset long")
    r = parse_tick_strict(ok).collect()[0]
    assert (r.symbol, r.timestampvalue, r.price, r.volume) == ("A", "2024-01-01 00:00:01", 12.5, 3)
    for bad in (BAD[1], BAD[2], BAD[5]):
        df = spark.createDataFrame([bad], "value string, offset long")
        with pytest.raises(Exception):
            parse_tick_strict(df).collect()


def test_ieee_division(spark):
    from tickwise.functions.columns import ieee_divide
    nan, inf = math.nan, math.inf
    cases = [(1.0, 0.0, inf), (1.0, -0.0, -inf), (-1.0, 0.0, -inf), (-1.0, -0.0, inf), (0.0, 0.0, nan), (nan, 0.0, nan),
             (inf, 0.0, inf), (6.0, -2.0, -3.0), (1.0, inf, 0.0), (None, 1.0, None), (1.0, None, None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a double, b double")
    got = dict(df.select("i", ieee_divide("a", "b")).collect())
    for i, (_, _, want) in enumerate(cases):
        assert got[i] == want or (want is not None and math.isnan(want) and math.isnan(got[i])), cases[i]
