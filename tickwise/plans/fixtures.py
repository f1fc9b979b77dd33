"""Tables of the tick pipeline derived from the given parquet tables.

The registered queries (``tickwise.plans.registry``) all start here, so every
one of them reads the whole given tables and grows with them.  The same
derivations are written once more in DuckDB SQL (the ``sql_*`` builders below)
for the oracle check.  The fixture parameters (window size, threshold, time of
day width, history/live split day, feed mark) are chosen once and shared by
both sides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import tick_json
from ..operators.alerts import ratio_alerts, stock_rows
from ..operators.history import hist_ratio_strict, ratio_query
from ..session import new_path
from ..sources.ticks import MINUTE_FORMAT, read_table, ticks_from_events

# Fixed parameters -------------------------------------------------------------
WINDOW = 3                       # count window size (documented usage example)
THRESHOLD = -100.0               # alert threshold (documented usage example)
TOD_WIDTH_TEST = 5               # time-of-day key "HH:mm" for lookups in tests
SPLIT_DAY = "2024-01-16"         # history before, live from this day on
FEED_MARK = "2024-01-23 00:00:00"  # high-water mark of the incremental feeds
FLAW_PERIOD = 23                 # one message in so many has each flaw
PART_DAYS = ("2024-01-21", "2024-01-26")   # where replays in three parts are cut
BURST_SYMBOL, BURST_TIME = "click", "2024-01-10 00:00:00"
# -------------------------------------------------------------------------------


def events_before(spark: SparkSession, sf_dir: str, before: bool) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    split = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return ev.where(F.col("ts") < split) if before else ev.where(F.col("ts") >= split)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(read_table(spark, sf_dir, "events"))


def minute_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(read_table(spark, sf_dir, "events"), MINUTE_FORMAT)


def done_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous run's output: ticks before the split day, minute timestamps."""
    return ratio_query(ticks_from_events(events_before(spark, sf_dir, True), MINUTE_FORMAT),
                       None, WINDOW)


def history(spark: SparkSession, sf_dir: str, width: int = TOD_WIDTH_TEST) -> DataFrame:
    """Historical-ratio lookup: strict Q2 over the batch ratios before the split."""
    trans = ratio_query(ticks_from_events(events_before(spark, sf_dir, True)), None, WINDOW)
    return hist_ratio_strict(trans, width)


def history_of_all(spark: SparkSession, sf_dir: str, width: int = TOD_WIDTH_TEST) -> DataFrame:
    """The same lookup over all ticks."""
    return hist_ratio_strict(ratio_query(ticks(spark, sf_dir), None, WINDOW), width)


def live_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(events_before(spark, sf_dir, False))


def three_parts(ticks: DataFrame) -> list[DataFrame]:
    """Ticks up to, between and from the days of ``PART_DAYS``."""
    part = sum((F.col("timestampvalue") >= d).cast("int") for d in PART_DAYS)
    return [ticks.where(part == i) for i in range(len(PART_DAYS) + 1)]


def two_topic_messages(ticks: DataFrame) -> DataFrame:
    """Tick messages of two topics of three partitions whose offsets clash."""
    t = F.col("tick_id")
    return ticks.select(tick_json(ts="timestampvalue").alias("value"),
                        F.when(t % 2 == 0, F.lit("ticks-b")).otherwise(F.lit("ticks")).alias("topic"),
                        (F.floor(t / 2) % 3).cast("int").alias("partition"),
                        F.floor(t / 6).cast("long").alias("offset"))


def live_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``stock`` table: real-time metric rows of the live ticks."""
    return stock_rows(live_ticks(spark, sf_dir), WINDOW)


def live_alerts(spark: SparkSession, sf_dir: str, width: int = TOD_WIDTH_TEST) -> DataFrame:
    """The ``stock_alert`` table of the live ticks against the history."""
    return ratio_alerts(live_ticks(spark, sf_dir), history(spark, sf_dir, width), WINDOW,
                        THRESHOLD, width=width)


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, as the pollers read it."""
    path = new_path(spark, "alerts")
    alerts = live_alerts(spark, sf_dir)
    alerts.write.parquet(path)
    return spark.read.schema(alerts.schema).parquet(path)


def flawed_messages(ticks: DataFrame) -> DataFrame:
    """Tick messages of which some are truncated, lack a field, hold JSON null
    or a number as text, repeat a field or name an invalid symbol, by tick_id."""
    case = F.pmod("tick_id", F.lit(FLAW_PERIOD))
    symbol = F.when(case == 6, F.lit("InvalidCo")).otherwise(F.col("symbol"))
    good = tick_json(symbol, "timestampvalue")
    text = F.concat(F.lit('{"symbol":"'), "symbol", F.lit('","timestampValue":"'), "timestampvalue", F.lit('"'))
    volume = F.concat(F.lit(',"volume":'), F.col("volume").cast("string"), F.lit("}"))
    value = (F.when(case == 1, F.substring(good, 1, 20)).when(case == 2, F.concat(text, volume))
             .when(case == 3, F.concat(text, F.lit(',"price":null'), volume))
             .when(case == 4, F.concat(text, F.lit(',"price":"'), F.col("price").cast("string"), F.lit('"'), volume))
             .when(case == 5, F.concat(F.lit('{"price":0,'), F.substring(good, 2, 1000))).otherwise(good))
    return ticks.select(value.alias("value"), F.col("tick_id").alias("offset"))


def scrambled_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose times lie up to ten minutes later, each by another amount:
    in arrival order (``tick_id``) they are not in time order."""
    events = read_table(spark, sf_dir, "events")
    late = F.expr("ts + make_dt_interval(0, 0, 0, (event_id * 7919) % 600)")
    return ticks_from_events(events.withColumn("ts", late))


def whole_number_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with prices in whole cents (so that long sums are exact); all of
    one symbol in a single second."""
    t = ticks(spark, sf_dir)
    return t.withColumn("price", F.floor(F.col("price") * 100).cast("double")).withColumn(
        "timestampvalue", F.when(F.col("symbol") == BURST_SYMBOL, F.lit(BURST_TIME)).otherwise(F.col("timestampvalue")))


def mixed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose time texts are seconds, minutes, hours, or no valid date."""
    case = F.pmod("tick_id", F.lit(7))
    part = lambda a, n: F.substring("timestampvalue", a, n)
    text = (F.when(case == 0, part(1, 16)).when(case == 1, part(1, 13))
            .when(case == 2, F.concat(part(1, 8), F.lit("31 "), part(12, 5))).otherwise(F.col("timestampvalue")))
    return ticks(spark, sf_dir).withColumn("timestampvalue", text)


def odd_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with repeated keys, many of whose time texts are no times."""
    hour = F.substring("timestampvalue", 1, 13)
    part = lambda a, n: F.substring("timestampvalue", a, n)
    case = F.pmod("tick_id", F.lit(5))
    text = (F.when(case == 0, hour).when(case == 1, F.concat(part(9, 2), F.lit("/"), part(6, 2), F.lit("/"), part(1, 4)))
            .when(case == 2, F.concat(F.lit("{bad json} "), part(1, 10)))
            .when(case == 3, F.concat(part(1, 4), F.lit(","), part(6, 2), F.lit(","), part(9, 2))))
    t = ticks(spark, sf_dir)
    return t.select("symbol", text.alias("timestampvalue"), F.col("price").alias("histratio"),
                    F.col("volume").cast("double").alias("currentratio"), F.col("tick_id").cast("double").alias("ratiodeviation"),
                    F.lit(THRESHOLD).alias("threshold"), "tick_id")


# ---- the same derivations in DuckDB SQL --------------------------------------

def sql_ticks(fmt: str = "%Y-%m-%d %H:%M:%S", where: str = "") -> str:
    return (f"select event_type as symbol, strftime(ts, '{fmt}') as timestampvalue, "
            f"value as price, cast(json_extract_string(props, '$.k') as int) as volume, "
            f"event_id as tick_id from events {where}")


SQL_BEFORE = f"where ts < timestamp '{SPLIT_DAY}'"
SQL_FROM = f"where ts >= timestamp '{SPLIT_DAY}'"
MINUTE = "%Y-%m-%d %H:%M"


def sql_window(src: str, n: int = WINDOW, key: str = "symbol",
               order: str = "timestampvalue nulls first, tick_id nulls first") -> str:
    w = f"partition by {key} order by {order} rows between {n - 1} preceding and current row"
    return (f"select *, avg(price) over ({w}) as avgprice, "
            f"avg(volume) over ({w}) as avgvolume from ({src}) w1")


def sql_metrics_batch(src: str) -> str:
    pc = "case when avgprice = 0 then null else (price - avgprice) * 100 / avgprice end"
    vc = "case when avgvolume = 0 then null else (volume - avgvolume) * 100 / avgvolume end"
    return (f"select symbol, timestampvalue, avgprice, pricechange, avgvolume as avgvol, "
            f"volumechange, coalesce(case when volumechange = 0 then null "
            f"else pricechange / volumechange end, 0) as ratio "
            f"from (select *, {pc} as pricechange, {vc} as volumechange from ({src}) m) p6")


def sql_ratio_query(ticks_sql: str, done_sql: str | None = None) -> str:
    src = ticks_sql
    if done_sql is not None:
        src = (f"select * from ({ticks_sql}) t where not exists (select 1 from ({done_sql}) d "
               f"where d.timestampvalue = t.timestampvalue)")
    return sql_metrics_batch(sql_window(src))


def _ieee(a: str, b: str) -> str:
    """IEEE double division in DuckDB SQL (its ``/`` gives NULL on zero)."""
    return (f"(case when ({a}) is null or ({b}) is null then null "
            f"when ({b}) <> 0 or isnan({b}) then ({a}) / ({b}) "
            f"when isnan({a}) or ({a}) = 0 then 'nan'::double "
            f"when ({a}) > 0 then 'inf'::double else '-inf'::double end)")


def _nz(x: str) -> str:
    return f"(case when isnan({x}) then 0.0 else {x} end)"


SQL_PART = " + ".join(f"cast(timestampvalue >= '{d}' as int)" for d in PART_DAYS)
SQL_POSITION = "case when tick_id % 2 = 0 then 'ticks-b' else 'ticks' end, tick_id // 2 % 3, tick_id // 6"


def sql_realtime(ticks_sql: str, rounded: bool = True,
                 order: str = "timestampvalue nulls first, tick_id nulls first") -> str:
    """Stream metrics (P4, P5 when rounded) over the count window, in SQL."""
    w = (f"partition by symbol order by {order} "
         f"rows between {WINDOW - 1} preceding and current row")
    win = (f"select symbol, timestampvalue, price, cast(volume as double) as volume, tick_id, "
           f"avg(price) over ({w}) as priceavg, avg(volume) over ({w}) as volumeavg "
           f"from ({ticks_sql}) t")
    pc = _ieee("(price - priceavg) * 100.0", "priceavg")
    vc = _ieee("(volume - volumeavg) * 100.0", "volumeavg")
    raw = f"select *, {pc} as pc, {vc} as vc from ({win}) w"
    r = (lambda c: f"(round({c}, 5) + 0.0)") if rounded else (lambda c: c)
    return (f"select trim(replace(symbol, '\"', ' ')) as symbol, "
            f"trim(replace(timestampvalue, '\"', ' ')) as timestampvalue, "
            f"{r('price')} as price, {r('volume')} as volume, {r('priceavg')} as priceavg, "
            f"{r(_nz('pc'))} as pricechange, {r('volumeavg')} as volumeavg, "
            f"{r(_nz('vc'))} as volumechange, {r(_nz(_ieee('pc', 'vc')))} as ratio, tick_id "
            f"from ({raw}) m")


def sql_first_wins(src: str, cols: str, order: str = "tick_id") -> str:
    return (f"select {cols} from (select *, row_number() over (partition by symbol, "
            f"timestampvalue order by {order}) as rn_fw from ({src}) s) f where rn_fw = 1")


STOCK_SQL_COLS = ("symbol, timestampvalue, price, volume, priceavg, pricechange, volumeavg, "
                  "volumechange, ratio")
ALERT_SQL_COLS = "symbol, timestampvalue, histratio, currentratio, ratiodeviation, threshold"


def sql_lookup_join(rows_sql: str, hist_sql: str, width: int = TOD_WIDTH_TEST) -> str:
    tod = (f"substring(split_part(trim(replace(r.timestampvalue, '\"', ' ')), ' ', 2), 1, {width})")
    return (f"select r.*, h.histratio from ({rows_sql}) r join ({hist_sql}) h "
            f"on r.symbol = h.symbol and {tod} = h.timestampvalue")


def sql_alert_rows(joined_sql: str, threshold: float = THRESHOLD) -> str:
    dev = "(case when histratio = 0 then null else (ratio - histratio) * 100 / histratio end)"
    return (f"select symbol, timestampvalue, round(histratio, 5) + 0.0 as histratio, "
            f"ratio as currentratio, round(dev, 5) + 0.0 as ratiodeviation, "
            f"{float(threshold)}::double as threshold, tick_id from "
            f"(select *, {dev} as dev from ({joined_sql}) j) d "
            f"where dev is not null and not isnan(dev) and not isinf(dev) and dev > {float(threshold)}")


def sql_messages(ticks_sql: str) -> str:
    """Tick JSON messages in DuckDB (``value`` text and ``offset``)."""
    return (f"select json_object('symbol', symbol, 'timestampValue', timestampvalue, "
            f"'price', price, 'volume', volume)::varchar as value, tick_id as \"offset\" "
            f"from ({ticks_sql}) t")


def sql_parse_lenient(msg_sql: str) -> str:
    """Happy-path lenient parse (all fixture messages are well formed)."""
    return (f"select json_extract(value, '$.symbol')::varchar as symbol, "
            f"json_extract(value, '$.timestampValue')::varchar as timestampvalue, "
            f"cast(json_extract_string(value, '$.price') as double) as price, "
            f"cast(json_extract_string(value, '$.volume') as double) as volume, \"offset\" "
            f"from ({msg_sql}) m")


def sql_parse_flawed(ticks_sql: str) -> str:
    """What the lenient parse makes of :func:`flawed_messages`."""
    case = f"tick_id % {FLAW_PERIOD}"
    bad = f"{case} in (1, 2)"
    return (f"select case when {bad} then 'Invalid' when {case} = 6 then '\"InvalidCo\"' "
            f"else '\"' || symbol || '\"' end as symbol, "
            f"case when {bad} then 'Invalid' else '\"' || timestampvalue || '\"' end as timestampvalue, "
            f"case when {bad} or {case} = 3 then 0.0 else price end as price, "
            f"case when {bad} then 0.0 else cast(volume as double) end as volume, tick_id as \"offset\" "
            f"from ({ticks_sql}) t")


def sql_scrambled() -> str:
    return ("select event_type as symbol, strftime(ts + to_seconds((event_id * 7919) % 600), '%Y-%m-%d %H:%M:%S') "
            "as timestampvalue, value as price, cast(json_extract_string(props, '$.k') as int) as volume, "
            "event_id as tick_id from events")


def sql_whole_number() -> str:
    return (f"select symbol, case when symbol = '{BURST_SYMBOL}' then '{BURST_TIME}' else timestampvalue end as "
            f"timestampvalue, cast(floor(price * 100) as double) as price, volume, tick_id from ({sql_ticks()}) t")


def sql_mixed() -> str:
    part = lambda a, n: f"substring(timestampvalue, {a}, {n})"
    return (f"select symbol, case tick_id % 7 when 0 then {part(1, 16)} when 1 then {part(1, 13)} "
            f"when 2 then {part(1, 8)} || '31 ' || {part(12, 5)} else timestampvalue end as timestampvalue, "
            f"price, volume, tick_id from ({sql_ticks()}) t")


def sql_odd_keys() -> str:
    part = lambda a, n: f"substring(timestampvalue, {a}, {n})"
    return (f"select symbol, case tick_id % 5 when 0 then {part(1, 13)} "
            f"when 1 then {part(9, 2)} || '/' || {part(6, 2)} || '/' || {part(1, 4)} "
            f"when 2 then '{{bad json}} ' || {part(1, 10)} "
            f"when 3 then {part(1, 4)} || ',' || {part(6, 2)} || ',' || {part(9, 2)} end as timestampvalue, "
            f"price as histratio, cast(volume as double) as currentratio, cast(tick_id as double) as ratiodeviation, "
            f"{THRESHOLD}::double as threshold, tick_id from ({sql_ticks()}) t")


def sql_java_double(x: str) -> str:
    """``Double.toString`` text of a double in DuckDB SQL: plain decimal for
    1e-3 <= |x| < 1e7, otherwise ``d.dddE<n>``."""
    s = f"abs({x})::varchar"
    ip, fp = f"split_part({s}, '.', 1)", f"split_part({s}, '.', 2)"
    raw = (f"(case when {s} like '%e%' then replace(split_part({s}, 'e', 1), '.', '') "
           f"when {ip} <> '0' then {ip} || {fp} else ltrim({fp}, '0') end)")
    exp = (f"(case when {s} like '%e%' then cast(split_part({s}, 'e', 2) as int) "
           f"when {ip} <> '0' then length({ip}) - 1 "
           f"else -(length({fp}) - length(ltrim({fp}, '0')) + 1) end)")
    digits = f"rtrim({raw}, '0')"
    mant = (f"(left({digits}, 1) || '.' || case when length({digits}) > 1 "
            f"then substr({digits}, 2) else '0' end)")
    sci = f"((case when {x} < 0 then '-' else '' end) || {mant} || 'E' || {exp}::varchar)"
    return (f"(case when {x} is null then null when isnan({x}) then 'NaN' "
            f"when {x} = 'inf'::double then 'Infinity' when {x} = '-inf'::double then '-Infinity' "
            f"when {x} = 0 then '0.0' "
            f"when abs({x}) >= 0.001 and abs({x}) < 10000000 then ({x})::varchar else {sci} end)")


def sql_json_value(x: str, kind: str) -> str:
    """One JSON value as Spark's ``to_json`` writes it: strings quoted and
    escaped, doubles in the JVM text form (NaN/Infinity as strings), NULL as
    ``null``."""
    if kind == "string":
        v = f"to_json({x})::varchar"
    elif kind == "int":
        v = f"({x})::varchar"
    else:
        v = (f"(case when isnan({x}) then '\"NaN\"' when {x} = 'inf'::double then '\"Infinity\"' "
             f"when {x} = '-inf'::double then '\"-Infinity\"' else {sql_java_double(x)} end)")
    return f"coalesce({v}, 'null')"


def sql_json_object(cols) -> str:
    """``to_json(struct(cols))`` for ``[(name, sql expr, kind)]``."""
    parts = []
    for i, (name, expr, kind) in enumerate(cols):
        sep = "{" if i == 0 else ","
        parts.append(f"'{sep}\"{name}\":' || {sql_json_value(expr, kind)}")
    return " || ".join(parts) + " || '}'"


def sql_text_template(template: str, **exprs) -> str:
    """The SQL ``||`` concatenation of a text template (see
    ``functions.columns.text_template``); ``exprs`` maps names to SQL text."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(f"({exprs[piece]})")
        elif piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return " || ".join(parts)
