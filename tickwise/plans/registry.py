"""Registered queries: one per operator of the survey inventory, each with the
DuckDB SQL that computes the same result (the correctness oracle).

Every query reads the whole given tables (``events`` as ticks, see
``fixtures``) and returns a DataFrame; nothing is capped, sampled or
filtered to make the check cheap.  Column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history as H
from ..operators import alerts as A
from ..operators.windows import moving_avg_rows
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

TS = "timestampvalue"
W5 = X.TOD_WIDTH_TEST

_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- shared SQL pieces ---------------------------------------------------------
T_ALL = X.sql_ticks()
T_MIN = X.sql_ticks(X.MINUTE)
T_MIN_BEFORE = X.sql_ticks(X.MINUTE, X.SQL_BEFORE)
T_BEFORE = X.sql_ticks(where=X.SQL_BEFORE)
T_LIVE = X.sql_ticks(where=X.SQL_FROM)
TRANS_ALL = X.sql_ratio_query(T_ALL)                    # first run over all ticks
DONE_MIN = X.sql_ratio_query(T_MIN_BEFORE)
TOD5 = f"substring(timestampvalue, 12, {W5})"


def _trans_all(spark, d):
    return H.ratio_query(X.ticks(spark, d), None, X.WINDOW)


# ---- W1, J1, P6, Q1 -------------------------------------------------------------

@register("moving_avg_rows",
          f"select symbol, timestampvalue, price, volume, tick_id, avgprice, avgvolume "
          f"from ({X.sql_window(T_ALL)}) q")
def q_moving_avg_rows(spark, d):
    return moving_avg_rows(X.ticks(spark, d), X.WINDOW).select(
        "symbol", TS, "price", "volume", "tick_id", "avgprice", "avgvolume")


@register("moving_avg_rows_split",
          f"select symbol, timestampvalue, price, volume, tick_id, avgprice, avgvolume "
          f"from ({X.sql_window(T_ALL)}) q")
def q_moving_avg_rows_split(spark, d):
    """W1 with every symbol split into hour chunks (the hot-symbol plan)."""
    return moving_avg_rows(X.ticks(spark, d), X.WINDOW, split=True).select(
        "symbol", TS, "price", "volume", "tick_id", "avgprice", "avgvolume")


@register("moving_avg_rows_lineitem",
          "select symbol, timestampvalue, price, volume, tick_id, avgprice, avgvolume from ("
          + X.sql_window("select cast(l_partkey as varchar) as symbol, "
                         "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as timestampvalue, "
                         "l_extendedprice as price, cast(l_quantity as int) as volume, "
                         "l_orderkey * 8 + l_linenumber as tick_id from lineitem") + ") q")
def q_moving_avg_rows_lineitem(spark, d):
    from ..sources.ticks import lineitem_ticks
    return moving_avg_rows(lineitem_ticks(spark, d), X.WINDOW).select(
        "symbol", TS, "price", "volume", "tick_id", "avgprice", "avgvolume")


LONG = 200       # a window longer than a burst's share of a second


@register("moving_avg_rows_long",
          "select symbol, timestampvalue, price, volume, tick_id, avgprice, avgvolume from ("
          + X.sql_window(X.sql_whole_number(), LONG) + ") q")
def q_moving_avg_rows_long(spark, d):
    """W1 over 200 rows with a small task target: symbols are split into chunks
    about as long as the window, one symbol has all its ticks in one second."""
    return moving_avg_rows(X.whole_number_ticks(spark, d), LONG, hot_rows=100).select(
        "symbol", TS, "price", "volume", "tick_id", "avgprice", "avgvolume")


_LINEITEM_TICKS_SQL = ("select cast(l_partkey as varchar) as symbol, "
                       "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as timestampvalue, "
                       "l_extendedprice as price, cast(l_quantity as int) as volume, "
                       "l_orderkey * 8 + l_linenumber as tick_id from lineitem")
_USER_TICKS_SQL = T_ALL.replace("select event_type as symbol", "select 'U' || user_id as symbol")


@register("ratio_query_lineitem", X.sql_ratio_query(_LINEITEM_TICKS_SQL))
def q_ratio_query_lineitem(spark, d):
    """Q1 (first run) over lineitem ticks: 20 000 symbols, day timestamps."""
    from ..sources.ticks import lineitem_ticks
    return H.ratio_query(lineitem_ticks(spark, d), None, X.WINDOW)


@register("ratio_query_users", X.sql_ratio_query(_USER_TICKS_SQL))
def q_ratio_query_users(spark, d):
    """Q1 (first run) with one symbol per user."""
    from ..sources.ticks import ticks_from_events_by_user
    return H.ratio_query(ticks_from_events_by_user(X.read_table(spark, d, "events")), None, X.WINDOW)


@register("delta_anti_join",
          f"select * from ({T_MIN}) t where not exists (select 1 from ({DONE_MIN}) d "
          f"where d.timestampvalue = t.timestampvalue)")
def q_delta_anti_join(spark, d):
    return H.delta_anti_join(X.minute_ticks(spark, d), X.done_minute(spark, d))


@register("metrics_batch", TRANS_ALL)
def q_metrics_batch(spark, d):
    return _trans_all(spark, d)


@register("ratio_query", X.sql_ratio_query(T_MIN, DONE_MIN))
def q_ratio_query(spark, d):
    return H.ratio_query(X.minute_ticks(spark, d), X.done_minute(spark, d), X.WINDOW)


@register("ratio_query_by_symbol",
          X.sql_metrics_batch(X.sql_window(
              f"select * from ({T_MIN}) t where not exists (select 1 from ({DONE_MIN}) d "
              "where d.timestampvalue = t.timestampvalue and d.symbol = t.symbol)")))
def q_ratio_query_by_symbol(spark, d):
    return H.ratio_query(X.minute_ticks(spark, d), X.done_minute(spark, d), X.WINDOW, by_symbol=True)


@register("ratio_query_carry",
          X.sql_metrics_batch(f"select * from ({X.sql_window(T_MIN)}) t where not exists "
                              f"(select 1 from ({DONE_MIN}) d where d.timestampvalue = t.timestampvalue)"))
def q_ratio_query_carry(spark, d):
    return H.ratio_query(X.minute_ticks(spark, d), X.done_minute(spark, d), X.WINDOW, carry_history=True)


# ---- A1, A2, J4, J2, Q2, A7 -------------------------------------------------------

@register("hist_avg_ratio",
          f"select symbol, {TOD5} as timehhmmss, avg(ratio) as historicalratio "
          f"from ({TRANS_ALL}) t group by all")
def q_hist_avg_ratio(spark, d):
    return H.hist_avg_ratio(_trans_all(spark, d), W5)


@register("max_ts_by_tod",
          f"select symbol, {TOD5} as timehhmmss, max(timestampvalue) as max_ts "
          f"from ({TRANS_ALL}) t group by all")
def q_max_ts_by_tod(spark, d):
    return H.max_ts_by_tod(_trans_all(spark, d), W5)


_SEMI_SQL = (f"select * from ({TRANS_ALL}) t where timestampvalue in "
             f"(select max(timestampvalue) from ({TRANS_ALL}) g group by symbol, {TOD5})")


@register("semi_latest", _SEMI_SQL)
def q_semi_latest(spark, d):
    t = _trans_all(spark, d)
    return H.semi_latest(t, H.max_ts_by_tod(t, W5))


_A1_SQL = (f"select symbol, {TOD5} as timehhmmss, avg(ratio) as historicalratio "
           f"from ({TRANS_ALL}) t group by all")


@register("hist_join_latest",
          f"select l.symbol, l.timehhmmss, l.timestampvalue, l.avgprice, l.pricechange, l.avgvol, "
          f"l.volumechange, l.ratio, g.historicalratio from "
          f"(select *, {TOD5} as timehhmmss from ({_SEMI_SQL}) s) l "
          f"join ({_A1_SQL}) g on l.symbol = g.symbol and l.timehhmmss = g.timehhmmss")
def q_hist_join_latest(spark, d):
    t = _trans_all(spark, d)
    return H.hist_join_latest(H.hist_avg_ratio(t, W5), H.semi_latest(t, H.max_ts_by_tod(t, W5)), W5)


def _sql_q2(rounded: bool, trans: str = TRANS_ALL) -> str:
    a1 = (f"select symbol, {TOD5} as timehhmmss, avg(ratio) as historicalratio "
          f"from ({trans}) t group by all")
    semi = (f"select * from ({trans}) t where timestampvalue in "
            f"(select max(timestampvalue) from ({trans}) g group by symbol, {TOD5})")
    r = (lambda c: f"round({c}, 5) + 0.0") if rounded else (lambda c: c)
    return (f"select t2.symbol, t1.timehhmmss as timestampvalue, {r('t2.avgprice')} as avgprice, "
            f"{r('t2.pricechange')} as pricechange, {r('t2.avgvol')} as avgvolume, "
            f"{r('t2.volumechange')} as volumechange, {r('t2.ratio')} as ratio, "
            f"{r('t1.historicalratio')} as histratio from ({a1}) t1 join ({semi}) t2 "
            f"on t1.symbol = t2.symbol and t1.timehhmmss = substring(t2.timestampvalue, 12, {W5})")


@register("hist_ratio_query", _sql_q2(True))
def q_hist_ratio_query(spark, d):
    return H.hist_ratio_query(_trans_all(spark, d), W5, rounded=True)


@register("hist_ratio_query_unrounded", _sql_q2(False))
def q_hist_ratio_query_unrounded(spark, d):
    return H.hist_ratio_query(_trans_all(spark, d), W5, rounded=False)


def _sql_strict(trans_sql: str, width: int = W5) -> str:
    tod = f"substring(timestampvalue, 12, {width})"
    r = lambda c: f"round({c}, 5) + 0.0"
    return (f"select symbol, timehhmmss as timestampvalue, {r('avgprice')} as avgprice, "
            f"{r('pricechange')} as pricechange, {r('avgvol')} as avgvolume, "
            f"{r('volumechange')} as volumechange, {r('ratio')} as ratio, {r('hr')} as histratio "
            f"from (select *, {tod} as timehhmmss, "
            f"avg(ratio) over (partition by symbol, {tod}) as hr, "
            f"row_number() over (partition by symbol, {tod} order by timestampvalue desc, "
            f"avgprice desc, pricechange desc, avgvol desc, volumechange desc, ratio desc) as rn "
            f"from ({trans_sql}) t) s where rn = 1")


@register("hist_ratio_strict", _sql_strict(TRANS_ALL))
def q_hist_ratio_strict(spark, d):
    return H.hist_ratio_strict(_trans_all(spark, d), W5)


@register("tod_avg_price_volume",
          f"select symbol, {TOD5} as timehhmmss, avg(price) as avgprice, avg(volume) as avgvol "
          f"from ({T_ALL}) t group by all")
def q_tod_avg_price_volume(spark, d):
    return H.tod_avg_price_volume(X.ticks(spark, d), W5)


# ---- P4, P5, Q3 (replay), J3, F2/F3, Q4, K2 -----------------------------------------

HIST_SQL = _sql_strict(X.sql_ratio_query(T_BEFORE))
RT_LIVE = X.sql_realtime(T_LIVE)
STOCK_SQL = X.sql_first_wins(RT_LIVE, X.STOCK_SQL_COLS)
JOINED_SQL = X.sql_lookup_join(RT_LIVE, HIST_SQL)
ALERTS_SQL = X.sql_first_wins(X.sql_alert_rows(JOINED_SQL), X.ALERT_SQL_COLS)


@register("realtime_ratio", X.sql_realtime(T_ALL, rounded=True))
def q_realtime_ratio(spark, d):
    return A.realtime_ratio(X.ticks(spark, d), X.WINDOW, rounded=True)


@register("metrics_stream", X.sql_realtime(T_ALL, rounded=False))
def q_metrics_stream(spark, d):
    return A.realtime_ratio(X.ticks(spark, d), X.WINDOW, rounded=False)


@register("historical_lookup", _sql_strict(TRANS_ALL))
def q_historical_lookup(spark, d):
    return X.history_of_all(spark, d)


STOCK_ALL_SQL = X.sql_first_wins(X.sql_realtime(T_ALL), X.STOCK_SQL_COLS)


@register("stock_rows", STOCK_ALL_SQL)
def q_stock_rows(spark, d):
    return A.stock_rows(X.ticks(spark, d), X.WINDOW)


@register("metrics_quoted",
          "select '\"' || symbol || '\"' as symbol, '\"' || timestampvalue || '\"' as timestampvalue, price, volume, "
          f"priceavg, pricechange, volumeavg, volumechange, ratio, tick_id from ({X.sql_realtime(T_ALL, rounded=False)}) m")
def q_metrics_quoted(spark, d):
    """The oldest stream variant: JSON quotes stay in the stored texts."""
    parsed = P.parse_tick_lenient(_messages(spark, d), keep=("offset",)).withColumnRenamed("offset", "tick_id")
    return A.realtime_ratio(parsed, X.WINDOW, rounded=False, clean=False)


@register("hist_lookup_join", JOINED_SQL)
def q_hist_lookup_join(spark, d):
    return A.hist_lookup_join(A.realtime_ratio(X.live_ticks(spark, d), X.WINDOW),
                              X.history(spark, d), W5)


@register("ratio_alerts", ALERTS_SQL)
def q_ratio_alerts(spark, d):
    return X.live_alerts(spark, d)


# ---- feeds: Q6-Q9, A3-A5, A8, U1, F4 ------------------------------------------------

from ..operators import feeds as FD  # noqa: E402

EVENT_SYMBOLS = ("click", "error", "purchase", "signup", "view")
MARK = X.FEED_MARK


@register("incremental_filter", f"select * from ({ALERTS_SQL}) a where timestampvalue > '{MARK}'")
def q_incremental_filter(spark, d):
    return FD.incremental_filter(X.live_alerts(spark, d), MARK)


@register("high_watermark", f"select max(timestampvalue) as high_watermark from ({STOCK_ALL_SQL}) s")
def q_high_watermark(spark, d):
    return FD.high_watermark(A.stock_rows(X.ticks(spark, d), X.WINDOW))


def _sql_dashboard(mark: str | None, ordered: bool = True) -> str:
    where = f"where c.timestampvalue > '{mark}' " if mark else ""
    return ("select c.symbol, c.timestampvalue as tmst, substring(c.timestampvalue, 1, 10) as \"dateValue\", "
            "substring(c.timestampvalue, 12, 8) as \"timeValue\", "
            "coalesce(a.currentratio, 0) as currentratio, coalesce(a.histratio, 0) as histratio, "
            "coalesce(a.ratiodeviation, 0) as ratiodeviation, coalesce(a.threshold, 0) as threshold, "
            "case when a.ratiodeviation is null then 0 else 1 end as \"alertFlag\", "
            "c.price, c.volume, c.priceavg, c.pricechange, c.volumeavg, c.volumechange "
            f"from ({STOCK_SQL}) c left join ({ALERTS_SQL}) a "
            "on c.symbol = a.symbol and c.timestampvalue = a.timestampvalue "
            + where + ("order by 2" if ordered else ""))


@register("dashboard_feed", _sql_dashboard(MARK))
def q_dashboard_feed(spark, d):
    return FD.dashboard_feed(X.live_stock(spark, d), X.live_alerts(spark, d), MARK)


@register("dashboard_feed_first_poll", _sql_dashboard(None))
def q_dashboard_feed_first_poll(spark, d):
    return FD.dashboard_feed(X.live_stock(spark, d), X.live_alerts(spark, d), None)


@register("alert_feed",
          "select symbol, substring(timestampvalue, 1, 19) as \"timestampValue\", "
          "substring(timestampvalue, 1, 10) as \"dateValue\", substring(timestampvalue, 12, 8) as \"timeValue\", "
          "histratio, currentratio, ratiodeviation, threshold, 1 as \"Alert\" "
          f"from ({ALERTS_SQL}) a where timestampvalue > '{MARK}' order by 2")
def q_alert_feed(spark, d):
    return FD.alert_feed(X.live_alerts(spark, d), MARK)


@register("alert_counts", f"select symbol, count(*) as count from ({ALERTS_SQL}) a group by symbol")
def q_alert_counts(spark, d):
    return FD.alert_counts(X.live_alerts(spark, d))


@register("alert_total", f"select 'TOTAL' as symbol, count(symbol) as alerts from ({ALERTS_SQL}) a")
def q_alert_total(spark, d):
    return FD.alert_total(X.live_alerts(spark, d))


_U1_SQL = (f"select symbol, count(*) as alerts from ({ALERTS_SQL}) a group by symbol union all "
           f"select 'TOTAL' as symbol, count(symbol) as alerts from ({ALERTS_SQL}) b")


@register("alerts_with_total", _U1_SQL)
def q_alerts_with_total(spark, d):
    return FD.alerts_with_total(X.live_alerts(spark, d))


@register("alert_pivot_feed",
          "select " + ", ".join(f"max(case when symbol = '{s}' then alerts end) as \"{s}\""
                                for s in (*EVENT_SYMBOLS, "TOTAL")) + f" from ({_U1_SQL}) u")
def q_alert_pivot_feed(spark, d):
    return FD.alert_pivot_feed(X.live_alerts(spark, d), EVENT_SYMBOLS)


# ---- P1, P2, F1, P3, Q3 from JSON text ------------------------------------------------

from ..operators import parse as P  # noqa: E402
from ..sources.ticks import tick_messages  # noqa: E402

MSG_SQL = X.sql_messages(T_ALL)


def _messages(spark, d):
    return tick_messages(X.ticks(spark, d))


FLAWED_SQL = X.sql_parse_flawed(T_ALL)


def _flawed(spark, d):
    return P.parse_tick_lenient(X.flawed_messages(X.ticks(spark, d)), keep=("offset",))


@register("parse_tick_lenient", FLAWED_SQL)
def q_parse_tick_lenient(spark, d):
    return _flawed(spark, d)


@register("parse_tick_strict",
          "select json_extract_string(value, '$.symbol') as symbol, "
          "json_extract_string(value, '$.timestampValue') as timestampvalue, "
          "cast(json_extract_string(value, '$.price') as double) as price, "
          "cast(json_extract_string(value, '$.volume') as int) as volume, \"offset\" "
          f"from ({MSG_SQL}) m")
def q_parse_tick_strict(spark, d):
    return P.parse_tick_strict(_messages(spark, d), keep=("offset",))


@register("clean_ticks",
          "select trim(replace(symbol, '\"', ' ')) as symbol, "
          "trim(replace(timestampvalue, '\"', ' ')) as timestampvalue, price, volume, \"offset\" "
          f"from ({FLAWED_SQL}) p where symbol not like '%Invalid%'")
def q_clean_ticks(spark, d):
    return P.clean_ticks(P.drop_invalid(_flawed(spark, d)))


@register("drop_invalid", f"select * from ({FLAWED_SQL}) p where symbol not like '%Invalid%'")
def q_drop_invalid(spark, d):
    return P.drop_invalid(_flawed(spark, d))


@register("realtime_ratio_json",
          X.sql_realtime("select symbol, timestampvalue, price, volume, \"offset\" as tick_id from ("
                         + FLAWED_SQL + ") p where symbol not like '%Invalid%'"))
def q_realtime_ratio_json(spark, d):
    ticks = P.drop_invalid(_flawed(spark, d)).withColumnRenamed("offset", "tick_id")
    return A.realtime_ratio(ticks, X.WINDOW, rounded=True)


# ---- Q5 alert messages, W3 + Q10 alert digest ------------------------------------------

J = X.sql_java_double


@register("alert_messages",
          "select symbol, timestampvalue, "
          + X.sql_text_template(A.ALERT_TEXT, symbol="symbol", ts="timestampvalue",
                                hist=J("histratio"), current=J("currentratio"),
                                deviation=J("ratiodeviation"), threshold=J("threshold"))
          + f" as message from ({ALERTS_SQL}) a")
def q_alert_messages(spark, d):
    return A.alert_messages(X.live_alerts(spark, d))


def _java_ts(c: str) -> str:
    return (f"(case when length({c}) = 19 then {c} || '.0' else "
            f"substring({c}, 1, 19) || '.' || rtrim(substring({c}, 21), '0') end)")


@register("running_first_last",
          f"select *, first_value(timestampvalue) over w as first_ts, max(timestampvalue) over w as last_ts "
          f"from ({ALERTS_SQL}) a where timestampvalue > '{MARK}' "
          "window w as (order by timestampvalue, symbol rows between unbounded preceding and current row)")
def q_running_first_last(spark, d):
    from ..operators.windows import running_first_last
    return running_first_last(FD.incremental_filter(X.stored_alerts(spark, d), MARK))


@register("alert_digest",
          "select symbol, timestampvalue, "
          + X.sql_text_template(FD.DIGEST_SUBJECT, first=_java_ts("first_ts"),
                                last=_java_ts("timestampvalue")) + " as subject, "
          + X.sql_text_template(FD.DIGEST_BODY, symbol="symbol", ts="timestampvalue",
                                hist=J("histratio"), current=J("currentratio"),
                                deviation=J("ratiodeviation"), threshold=J("threshold"))
          + " as body from (select *, min(timestampvalue) over () as first_ts from ("
          + ALERTS_SQL + f") a where timestampvalue > '{MARK}') b order by timestampvalue, symbol")
def q_alert_digest(spark, d):
    return FD.alert_digest(X.stored_alerts(spark, d), MARK)


# ---- streaming: W2 with keyed state, Q3, Q4 stream-static, K2 ---------------------------

from . import replay as R  # noqa: E402
from ..streaming import realtime as RT  # noqa: E402
from ..streaming.count_window import count_window_stream  # noqa: E402
from .. import schemas as S  # noqa: E402
from ..sources.sinks import first_wins_append, overwrite_table, write_batch  # noqa: E402
from ..sources.streams import message_file_stream  # noqa: E402
from ..session import new_path  # noqa: E402

PARSED_SQL = ("select symbol, timestampvalue, price, volume, \"offset\" as tick_id from ("
              + X.sql_parse_lenient(MSG_SQL) + ") p where symbol not like '%Invalid%'")
LIVE_MSG_SQL = X.sql_messages(T_LIVE)
LIVE_PARSED_SQL = ("select symbol, timestampvalue, price, volume, \"offset\" as tick_id from ("
                   + X.sql_parse_lenient(LIVE_MSG_SQL) + ") p where symbol not like '%Invalid%'")
_W = ("partition by symbol order by tick_id nulls first "
      f"rows between {X.WINDOW - 1} preceding and current row")


@register("count_window_stream",
          f"select symbol, timestampvalue, tick_id, price, cast(volume as double) as volume, "
          f"avg(price) over ({_W}) as priceavg, avg(volume) over ({_W}) as volumeavg "
          f"from ({PARSED_SQL}) t")
def q_count_window_stream(spark, d):
    stream = R.stage(spark, _messages(spark, d), "w2")
    return R.run_to_table(spark, count_window_stream(RT.parsed_ticks(stream), X.WINDOW), "w2")


def _register_replays():
    for slices in (1, 3):
        @register(f"count_window_stream_{slices}mb", _SQL["count_window_stream"])
        def q(spark, d, slices=slices):
            """W2 cut into as many micro-batches."""
            stream = R.stage(spark, _messages(spark, d), "w2", slices)
            return R.run_to_table(spark, count_window_stream(RT.parsed_ticks(stream), X.WINDOW), "w2")


_register_replays()
_ONE = "order by tick_id nulls first rows between 99 preceding and current row"


@register("count_window_hot_key",
          f"select 'all' as symbol, timestampvalue, tick_id, cast(floor(price * 100) as double) as price, "
          f"cast(volume as double) as volume, avg(cast(floor(price * 100) as double)) over ({_ONE}) as priceavg, "
          f"avg(volume) over ({_ONE}) as volumeavg from ({PARSED_SQL}) t")
def q_count_window_hot_key(spark, d):
    """W2 over 100 ticks, all of one key, in three micro-batches, of which only
    a thousand rows are put in order in memory at a time."""
    ticks = RT.parsed_ticks(R.stage(spark, _messages(spark, d), "w2h", 3))
    one = ticks.withColumn("symbol", F.lit("all")).withColumn("price", F.floor(F.col("price") * 100).cast("double"))
    return R.run_to_table(spark, count_window_stream(one, 100, held_rows=1000), "w2h")


@register("count_window_stream_split",
          f"select symbol, timestampvalue, tick_id, price, cast(volume as double) as volume, "
          f"avg(price) over ({_W}) as priceavg, avg(volume) over ({_W}) as volumeavg "
          f"from ({PARSED_SQL}) t")
def q_count_window_stream_split(spark, d):
    """W2 per micro-batch with a state table (the skew-safe streaming plan)."""
    from ..streaming.count_window import start_count_window_batches
    stream = R.stage(spark, _messages(spark, d), "w2s")
    out = new_path(spark, "w2s-out")
    R.finish(start_count_window_batches(RT.parsed_ticks(stream), X.WINDOW, out,
                                        new_path(spark, "w2s-state"), new_path(spark, "w2s-ckpt")))
    return spark.read.parquet(out).select("symbol", TS, "tick_id", "price", "volume",
                                          "priceavg", "volumeavg")


@register("count_window_out_of_order",
          f"select symbol, timestampvalue, tick_id, price, cast(volume as double) as volume, "
          f"avg(price) over ({_W}) as priceavg, avg(volume) over ({_W}) as volumeavg from ("
          "select '\"' || symbol || '\"' as symbol, '\"' || timestampvalue || '\"' as timestampvalue, price, volume, "
          f"tick_id from ({X.sql_scrambled()}) s) t")
def q_count_window_out_of_order(spark, d):
    """W2 over ticks that do not arrive in time order, in ten micro-batches."""
    stream = R.stage(spark, tick_messages(X.scrambled_ticks(spark, d)), "w2o")
    return R.run_to_table(spark, count_window_stream(RT.parsed_ticks(stream), X.WINDOW), "w2o")


@register("realtime_ratio_stream", X.sql_realtime(PARSED_SQL))
def q_realtime_ratio_stream(spark, d):
    stream = R.stage(spark, _messages(spark, d), "q3")
    return R.run_to_table(spark, RT.realtime_stream(stream, X.WINDOW), "q3")


def _run_alert_job(spark, d, fresh: bool):
    stream = R.stage(spark, tick_messages(X.live_ticks(spark, d)), "q4")
    stock, alerts = new_path(spark, "stock"), new_path(spark, "stock_alert")
    # the fresh-history run also uses the per-micro-batch (state table) window
    kw = {"state_path": new_path(spark, "q4-state")} if fresh else {}
    if fresh:
        hist_path = new_path(spark, "stock_transformation")
        overwrite_table(X.history(spark, d), hist_path)
        kw["hist_path"] = hist_path
    else:
        kw["hist"] = X.history(spark, d)
    q = RT.start_realtime_alerts(spark, stream, X.WINDOW, X.THRESHOLD, stock, alerts,
                                 new_path(spark, "q4-ckpt"), width=W5,
                                 state_partitions=R.state_partitions(spark), **kw)
    R.finish(q)
    return stock, alerts


@register("ratio_alerts_stream",
          X.sql_first_wins(X.sql_alert_rows(X.sql_lookup_join(X.sql_realtime(LIVE_PARSED_SQL),
                                                               HIST_SQL)), X.ALERT_SQL_COLS))
def q_ratio_alerts_stream(spark, d):
    _, alerts = _run_alert_job(spark, d, fresh=False)
    return spark.read.parquet(alerts).select(*A.ALERT_COLS)


@register("stock_rows_stream", X.sql_first_wins(X.sql_realtime(LIVE_PARSED_SQL), X.STOCK_SQL_COLS))
def q_stock_rows_stream(spark, d):
    stock, _ = _run_alert_job(spark, d, fresh=True)
    return spark.read.parquet(stock).select(*A.STOCK_COLS)


@register("ratio_alerts_fresh_stream", _SQL["ratio_alerts_stream"])
def q_ratio_alerts_fresh_stream(spark, d):
    """The history is read anew by every micro-batch."""
    _, alerts = _run_alert_job(spark, d, fresh=True)
    return spark.read.parquet(alerts).select(*A.ALERT_COLS)


# ---- three micro-batches with restarts: log, polls, failure, changing history, two topics ----

def _run_parts(spark, d, name, parts=None, each=None, read=None, **kw):
    """The alert job over the live ticks in three parts, started anew for each;
    ``each(part, stock, alerts)`` is called after a part, and ``before`` a
    start.  Returns the paths of stock and alerts."""
    src, ckpt, stock, alerts = (new_path(spark, f"{name}-{x}") for x in ("src", "ckpt", "stock", "alerts"))
    if parts is None:
        parts = [tick_messages(t) for t in X.three_parts(X.live_ticks(spark, d))]
    read = read or (lambda path: message_file_stream(spark, path))
    before, fails = kw.pop("before", None), kw.pop("fails", ())
    if "hist_path" not in kw:
        kw["hist"] = X.history(spark, d)

    def start(part, between=None):
        return RT.start_realtime_alerts(spark, read(src), X.WINDOW, X.THRESHOLD, stock, alerts, ckpt, width=W5,
                                        state_partitions=R.state_partitions(spark), between=between, **kw)

    def fail(batch_id):
        raise RuntimeError(f"{FAILURE} {batch_id}")

    def run(part):
        if before:
            before(part)
        if part in fails:
            R.expect_failure(start(part, fail), FAILURE)
            if before:
                before(part, again=True)
        return start(part)

    for i, part in enumerate(parts):
        R.in_parts([part], src, lambda _: run(i))
        if each:
            each(i, stock, alerts)
    return stock, alerts


FAILURE = "write stopped on purpose in micro-batch"
_LIVE_STOCK_SQL = X.sql_first_wins(X.sql_realtime(LIVE_PARSED_SQL), X.STOCK_SQL_COLS)
_LOG_SQL = "select {part} as batch_id, count(*) as rows, max(timestampvalue) as mark from ({src}) t group by 1"


@register("ingest_log", _LOG_SQL.format(part=X.SQL_PART, src=T_ALL))
def q_ingest_log(spark, d):
    """Rows and latest time of each ingested micro-batch."""
    from ..streaming.batch_log import read_log
    from ..streaming.ingest import start_ingest
    src, out, log, ckpt = (new_path(spark, f"ingest-log-{x}") for x in ("src", "out", "log", "ckpt"))
    R.in_parts([tick_messages(t) for t in X.three_parts(X.ticks(spark, d))], src, lambda _: start_ingest(
        message_file_stream(spark, src), out, ckpt, trigger={"availableNow": True}, log_path=log))
    return read_log(spark, log)


@register("stock_log",
          f"select batch_id, rows, mark, max(mark) over (order by batch_id) as high_watermark from ("
          + _LOG_SQL.format(part=X.SQL_PART, src=_LIVE_STOCK_SQL) + ") l")
def q_stock_log(spark, d):
    """Rows appended to ``stock`` per micro-batch and the mark a poll
    after it starts from, read from the log alone; the second micro-batch fails
    between its writes and is replayed."""
    from ..streaming.batch_log import logged_watermark, read_log
    log, out = new_path(spark, "stock-log"), new_path(spark, "stock-marks")
    _run_parts(spark, d, "log", stock_log=log, fails=(1,),
               each=lambda i, stock, alerts: write_batch(logged_watermark(spark, log), out, i))
    return read_log(spark, log).join(spark.read.parquet(out), "batch_id")


@register("restart_after_failure",
          f"select 'stock' as kind, symbol, timestampvalue, ratio as number from ({_LIVE_STOCK_SQL}) s union all "
          f"select 'alert', symbol, timestampvalue, ratiodeviation from ({_SQL['ratio_alerts_stream']}) a")
def q_restart_after_failure(spark, d):
    """The second micro-batch fails after its first write and is replayed after a restart."""
    stock, alerts = _run_parts(spark, d, "fail", fails=(1,))
    return spark.read.parquet(stock).select(F.lit("stock").alias("kind"), "symbol", TS, F.col("ratio").alias("number")).unionByName(
        spark.read.parquet(alerts).select(F.lit("alert").alias("kind"), "symbol", TS, F.col("ratiodeviation").alias("number")))


_HIST_BY_PART = " union all ".join(
    f"select {i} as part, symbol, timestampvalue, histratio * {f:.1f} as histratio from ({HIST_SQL}) h{i}"
    for i, f in enumerate((1, -2, 3)))


@register("ratio_alerts_changing_history",
          X.sql_first_wins(X.sql_alert_rows(
              "select r.*, h.histratio from (select *, " + X.SQL_PART + " as part from ("
              + X.sql_realtime(LIVE_PARSED_SQL) + f") q) r join ({_HIST_BY_PART}) h on r.symbol = h.symbol and "
              f"r.part = h.part and substring(split_part(r.timestampvalue, ' ', 2), 1, {W5}) = h.timestampvalue"),
              X.ALERT_SQL_COLS))
def q_ratio_alerts_changing_history(spark, d):
    """The history has a new run before each micro-batch; the second one
    fails after its first write, and another run is there when it is replayed:
    it joins the run of its first attempt."""
    from ..sources.sinks import RUN
    hist_path, first = new_path(spark, "hist-runs"), new_path(spark, "hist-first")
    X.history(spark, d).write.parquet(first)

    def new_run(part, again=False):
        factor = 7.0 if again else (1.0, -2.0, 3.0)[part]
        hist = spark.read.parquet(first).withColumn("histratio", F.col("histratio") * factor)
        overwrite_table(hist, f"{hist_path}/{RUN}={2 * part + again}")

    _, alerts = _run_parts(spark, d, "fresh", hist_path=hist_path, before=new_run, fails=(1,))
    return spark.read.parquet(alerts).select(*A.ALERT_COLS)


_TOPIC_ORDER = f"{X.SQL_PART}, {X.SQL_POSITION}"
_LIVE_QUOTED_SQL = ("select '\"' || symbol || '\"' as symbol, timestampvalue, price, volume, tick_id from (" + T_LIVE + ") q")


@register("stock_rows_two_topics",
          X.sql_first_wins(X.sql_realtime(_LIVE_QUOTED_SQL, order=_TOPIC_ORDER), X.STOCK_SQL_COLS, _TOPIC_ORDER))
def q_stock_rows_two_topics(spark, d):
    """P1, W2 and K2 over messages of two topics whose offsets clash: windows
    and first rows follow (topic, partition, offset) inside a micro-batch."""
    from ..sources.connectors import with_positions
    from ..sources.streams import TOPIC_SCHEMA
    parts = [X.two_topic_messages(t) for t in X.three_parts(X.live_ticks(spark, d))]
    stock, _ = _run_parts(spark, d, "topics", parts, read=lambda path: with_positions(
        message_file_stream(spark, path, schema=TOPIC_SCHEMA)))
    return spark.read.parquet(stock).select(*A.STOCK_COLS)


@register("keyed_append",
          f"select {X.ALERT_SQL_COLS} from (select *, row_number() over (partition by symbol, timestampvalue "
          f"order by case when tick_id % 3 = 0 then 0 else 1 end, tick_id) as rn from ({X.sql_odd_keys()}) o) k where rn = 1")
def q_keyed_append(spark, d):
    """K2 in two batches over keys whose time texts are mostly no times."""
    rows, path = X.odd_key_rows(spark, d), new_path(spark, "keyed")
    first = F.col("tick_id") % 3 == 0
    for batch_id, batch in enumerate((rows.where(first), rows.where(~first), rows)):
        first_wins_append(batch, path, batch_id, S.ALERT)
    return spark.read.parquet(path).select(*A.ALERT_COLS)


# ---- the batch job's tables: transformed rows, history (overwrite, upsert, partitioned) ----

JOB_TRANS_SQL = (f"select * from ({DONE_MIN}) a union all select * from ({X.sql_ratio_query(T_MIN, DONE_MIN)}) b")
_HIST_ORDER = ", ".join(f"{c} desc nulls last" for c in H.HISTORY_COLS[2:])


def _sql_job_history(rounded: bool) -> str:
    return (f"select {', '.join(H.HISTORY_COLS)} from (select *, row_number() over (partition by symbol, timestampvalue "
            f"order by {_HIST_ORDER}) as rn from ({_sql_q2(rounded, JOB_TRANS_SQL)}) h) k where rn = 1")


def _run_job_twice(spark, d, **kw):
    """Raw ticks before the split day, a run, then all of them, another run."""
    from .jobs import run_batch_ratio_job
    raw, trans, hist = (new_path(spark, f"job-{x}") for x in ("raw", "trans", "hist"))
    before = F.col(TS) < F.lit(X.SPLIT_DAY)
    for run, part in enumerate((before, ~before)):
        X.minute_ticks(spark, d).where(part).write.mode("append").parquet(raw)
        run_batch_ratio_job(spark, raw, trans, hist, X.WINDOW, width=W5, run_id=run, **kw)
    return trans, hist


@register("batch_job_transformed", JOB_TRANS_SQL)
def q_batch_job_transformed(spark, d):
    return spark.read.parquet(_run_job_twice(spark, d)[0])


@register("batch_job_partitioned", JOB_TRANS_SQL)
def q_batch_job_partitioned(spark, d):
    """The transformed table partitioned by symbol."""
    return spark.read.parquet(_run_job_twice(spark, d, partitioned=True)[0]).select(*H.TRANSFORMED_COLS)


@register("batch_job_history", _sql_job_history(True))
def q_batch_job_history(spark, d):
    from .jobs import read_history
    return read_history(spark, _run_job_twice(spark, d)[1])


@register("batch_job_history_upsert", _sql_job_history(False))
def q_batch_job_history_upsert(spark, d):
    from .jobs import read_history
    return read_history(spark, _run_job_twice(spark, d, rounded=False, upsert=True)[1])


# the incremental job: J1 by bitmaps of timestamps, Q2 from merged groups, over texts of several forms
_MIX = X.sql_mixed()
_MIX1 = X.sql_ratio_query(f"select * from ({_MIX}) t where timestampvalue < '{X.SPLIT_DAY}'")
_MIX2 = (f"select * from ({_MIX1}) a union all "
         + X.sql_ratio_query(f"select * from ({_MIX}) t where symbol <> 'view'", _MIX1))
MIXED_TRANS_SQL = f"select * from ({_MIX2}) a union all select * from ({X.sql_ratio_query(_MIX, _MIX2)}) b"


def _run_incremental(spark, d):
    """Three runs: the ticks before the split day, then those of all symbols
    but one, then all."""
    from .jobs import run_incremental_ratio_job
    raw, trans, hist, state = (new_path(spark, f"inc-{x}") for x in ("raw", "trans", "hist", "state"))
    before, late = F.col(TS) < F.lit(X.SPLIT_DAY), F.col("symbol") == "view"
    for run, part in enumerate((before, ~before & ~late, ~before & late)):
        X.mixed_ticks(spark, d).where(part).write.mode("append").parquet(raw)
        run_incremental_ratio_job(spark, raw, trans, hist, state, X.WINDOW, width=W5, run_id=run)
    return trans, hist


@register("incremental_job_transformed", MIXED_TRANS_SQL)
def q_incremental_job_transformed(spark, d):
    return spark.read.parquet(_run_incremental(spark, d)[0])


@register("incremental_job_history",
          f"select {', '.join(H.HISTORY_COLS)} from (select *, row_number() over (partition by symbol, timestampvalue "
          f"order by {_HIST_ORDER}) as rn from ({_sql_q2(True, MIXED_TRANS_SQL)}) h) k where rn = 1")
def q_incremental_job_history(spark, d):
    from .jobs import read_history
    return read_history(spark, _run_incremental(spark, d)[1])


_UP1, _UP2 = HIST_SQL, _sql_strict(X.sql_ratio_query(f"select * from ({T_LIVE}) t where symbol in ('click', 'view')"))
_KEYED = "symbol, timestampvalue, avgprice, pricechange, avgvolume, volumechange, ratio, histratio"


@register("history_upsert_buckets",
          f"select {_KEYED} from ({_UP2}) b union all select {_KEYED} from ({_UP1}) a where not exists "
          f"(select 1 from ({_UP2}) c where c.symbol = a.symbol and c.timestampvalue = a.timestampvalue)")
def q_history_upsert_buckets(spark, d):
    """K3: the second batch changes some keys of the first, misses others and
    brings new ones; only buckets with its keys are written again."""
    from ..sources.sinks import upsert_buckets
    path, live = new_path(spark, "upsert-buckets"), F.col("symbol").isin("click", "view")
    later = H.hist_ratio_strict(H.ratio_query(X.live_ticks(spark, d).where(live), None, X.WINDOW), W5)
    for batch in (X.history(spark, d), later):
        upsert_buckets(batch, path, 16)
    return spark.read.parquet(path).select(*H.HISTORY_COLS)


@register("ingest", f"select symbol, timestampvalue, price, volume, tick_id from ({T_ALL}) t")
def q_ingest(spark, d):
    """Raw ticks by micro-batches of messages (strict parse, observed count)."""
    from ..streaming.ingest import start_ingest
    out = new_path(spark, "ingest")
    R.finish(start_ingest(R.stage(spark, _messages(spark, d), "ingest"), out, new_path(spark, "ingest-ckpt"),
                          trigger={"availableNow": True}))
    return spark.read.parquet(out).select("symbol", TS, "price", "volume", "tick_id")

# ---- payloads (sink_dashboard_json), short alert text (Q5 variant), wide-store rows -------

_DASH_SQL = _sql_dashboard(MARK, ordered=False)
_DASH_KINDS = {"symbol": "string", "tmst": "string", "dateValue": "string", "timeValue": "string",
               "alertFlag": "int"}


@register("dashboard_json",
          "select " + X.sql_json_object([(c, f'"{c}"', _DASH_KINDS.get(c, "double"))
                                         for c in FD.DASHBOARD_COLUMNS])
          + f" as json from ({_DASH_SQL}) f")
def q_dashboard_json(spark, d):
    feed = FD.dashboard_feed(X.live_stock(spark, d), X.live_alerts(spark, d), MARK, ordered=False)
    return FD.json_rows(feed, FD.DASHBOARD_COLUMNS)


@register("alert_counts_payload",
          "select " + X.sql_json_object([("symbol", "symbol", "string"),
                                         ("count", "cast(count as varchar)", "string")])
          + f" as json from (select symbol, count(*) as count from ({ALERTS_SQL}) a group by symbol) c")
def q_alert_counts_payload(spark, d):
    return FD.count_payload_rows(FD.alert_counts(X.live_alerts(spark, d)))


@register("alert_pivot_payload",
          "select " + X.sql_json_object([(c, f'cast("{c}" as varchar)', "string")
                                         for c in (*EVENT_SYMBOLS, "TOTAL")])
          + " as json from (select " + ", ".join(
              f"max(case when symbol = '{c}' then alerts end) as \"{c}\"" for c in (*EVENT_SYMBOLS, "TOTAL"))
          + f" from ({_U1_SQL}) u) p")
def q_alert_pivot_payload(spark, d):
    return FD.count_payload_rows(FD.alert_pivot_feed(X.live_alerts(spark, d), EVENT_SYMBOLS))


@register("alert_messages_short",
          "select symbol, timestampvalue, "
          + X.sql_text_template(A.ALERT_TEXT_OLD, symbol="symbol", ts="timestampvalue",
                                hist=J("histratio"), deviation=J("ratiodeviation"))
          + f" as message from ({ALERTS_SQL}) a")
def q_alert_messages_short(spark, d):
    return A.alert_messages(X.live_alerts(spark, d), with_numbers=False)


@register("wide_store_rows",
          "select symbol, timestampvalue, avgprice, avgvolume, pricechange, volumechange, ratio, "
          "histratio from (select symbol, split_part(timestampvalue, ' ', 2) as timestampvalue, "
          "priceavg as avgprice, volumeavg as avgvolume, pricechange, volumechange, ratio, "
          "ratio as histratio, row_number() over (partition by symbol, split_part(timestampvalue, ' ', 2) "
          f"order by tick_id desc) as rn from ({X.sql_realtime(T_ALL, rounded=False)}) m) w where rn = 1")
def q_wide_store_rows(spark, d):
    return A.wide_store_rows(A.realtime_ratio(X.ticks(spark, d), X.WINDOW, rounded=False))


# ---- K1 feeds and the K3 store as streams -------------------------------------------------

WIDE_SQL = _SQL["wide_store_rows"]


@register("wide_store_stream", WIDE_SQL)
def q_wide_store_stream(spark, d):
    out = new_path(spark, "wide")
    stream = RT.realtime_stream(R.stage(spark, _messages(spark, d), "wide"), X.WINDOW, rounded=False)
    R.finish(RT.start_wide_store_sink(spark, stream, out, new_path(spark, "wide-ckpt")))
    return RT.read_wide_store(spark, out)


def _feed_table(spark, name, start):
    """Run a feed over everything written so far; its rows as a table."""
    out = new_path(spark, name)
    R.finish(start(new_path(spark, f"{name}-ckpt"), lambda rows, batch_id: write_batch(rows, out, batch_id)))
    return spark.read.parquet(out).drop("batch_id")


@register("dashboard_feed_stream",
          "select " + X.sql_json_object([(c, f'"{c}"', _DASH_KINDS.get(c, "double"))
                                         for c in FD.DASHBOARD_COLUMNS])
          + f" as json from ({_sql_dashboard(None, ordered=False)}) f")
def q_dashboard_feed_stream(spark, d):
    from ..streaming.feeds import start_dashboard_feed
    stock, alerts = _run_alert_job(spark, d, fresh=False)
    return _feed_table(spark, "dashboard", lambda ckpt, deliver: start_dashboard_feed(
        spark, stock, alerts, ckpt, deliver=deliver))


@register("dashboard_feed_polls",
          f"select {X.SQL_PART.replace(TS, 'tmst')} as poll, "
          + X.sql_json_object([(c, f'"{c}"', _DASH_KINDS.get(c, "double")) for c in FD.DASHBOARD_COLUMNS])
          + f" as json from ({_sql_dashboard(None, ordered=False)}) f")
def q_dashboard_feed_polls(spark, d):
    """K1: three polls of the dashboard feed, one after each micro-batch of the
    alert job; each resumes from its checkpoint and delivers only new rows."""
    from ..streaming.feeds import start_dashboard_feed
    ckpt, out = new_path(spark, "polls-ckpt"), new_path(spark, "polls")

    def poll(i, stock, alerts):
        R.finish(start_dashboard_feed(spark, stock, alerts, ckpt, deliver=lambda rows, batch_id: write_batch(
            rows.withColumn("poll", F.lit(i)), out, batch_id)))

    _run_parts(spark, d, "polls", each=poll)
    return spark.read.parquet(out).drop("batch_id")


@register("alert_digest_stream", _SQL["alert_digest"].replace(f"where timestampvalue > '{MARK}'", ""))
def q_alert_digest_stream(spark, d):
    from ..streaming.feeds import start_alert_digest
    _, alerts = _run_alert_job(spark, d, fresh=False)
    return _feed_table(spark, "digest", lambda ckpt, deliver: start_alert_digest(
        spark, alerts, ckpt, deliver=deliver))
