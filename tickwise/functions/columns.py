"""Column expressions shared by batch and streaming jobs.

Everything here is a built-in Spark expression (whole-stage codegen, no Python
at run time).  Spark 4 runs with ANSI mode on, where ``x / 0`` raises, so the
two division semantics of the source system are spelled out explicitly:

* batch (SQL) division: a zero divisor gives NULL  -> ``try_divide``
* stream (JVM double) division: IEEE 754, ``x/0 = +-Infinity``, ``0/0 = NaN``
  -> :func:`ieee_divide`
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")

# Fixed values of the source system -------------------------------------------
# character positions inside "yyyy-MM-dd HH:mm:ss[.S]" (1-based, SQL style)
DATE_START, DATE_LEN = 1, 10         # yyyy-MM-dd
TOD_START, TOD_WIDTH = 12, 8         # HH:mm:ss
TS_TEXT_LEN = 19                     # yyyy-MM-dd HH:mm:ss (drops the ".S")
ROUND_DECIMALS = 5                   # "%.5f" / round(x, 5)
INVALID = "Invalid"                  # marker of an unparsable tick
# ------------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tod(ts, width: int = TOD_WIDTH) -> Column:
    """Time of day: ``substring(ts, 12, width)`` (``HH:mm:ss`` for width 8)."""
    return F.substring(col(ts), TOD_START, width)


def date_part(ts) -> Column:
    return F.substring(col(ts), DATE_START, DATE_LEN)


def clean_quotes(c) -> Column:
    """``replace('"', ' ').trim``: JSON text keeps its quotes until here."""
    return F.trim(F.translate(col(c), '"', " "))


def tod_of_raw(ts, width: int = TOD_WIDTH) -> Column:
    """Time of day of a raw stream timestamp: quotes removed, the part after
    the first blank, cut to ``width`` characters.  Where the source code would
    throw (no blank, NULL) this yields NULL, so the row never matches."""
    return F.substring(F.try_element_at(F.split(clean_quotes(ts), " "), F.lit(2)), 1, width)


def pct_change_sql(x, avg) -> Column:
    """``(x - avg) * 100 / avg`` with SQL semantics (NULL on a zero divisor)."""
    return F.try_divide((col(x) - col(avg)) * F.lit(100), col(avg))


def ratio_sql(pc, vc) -> Column:
    """``NVL(pc / vc, 0)`` with SQL semantics."""
    return F.coalesce(F.try_divide(col(pc), col(vc)), F.lit(0.0))


def ieee_divide(a, b) -> Column:
    """``a / b`` with IEEE-754 double semantics, ANSI-safe."""
    a, b = col(a).cast("double"), col(b).cast("double")
    negative = b.cast("string") == "-0.0"            # the sign of a zero divisor counts
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(F.isnan(a) | (a == 0), F.lit(NAN))
            .when((a > 0) != negative, F.lit(INF))
            .otherwise(F.lit(-INF)))


def nan_to_zero(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(0.0)).otherwise(c)


def is_finite(c) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INF))


def round5(c, decimals: int = ROUND_DECIMALS) -> Column:
    """Half-up rounding on the decimal text of the double (as ``"%.5f"``);
    NaN and +-Infinity pass through unchanged."""
    return F.round(col(c), decimals)


def deviation(current, hist) -> Column:
    """``(current - hist) * 100 / hist``; NULL where the source would get
    NaN/Infinity (hist 0, or an infinite current ratio)."""
    d = F.try_divide((col(current) - col(hist)) * F.lit(100), col(hist))
    return F.when(is_finite(d), d)


def text_template(template: str, **columns) -> Column:
    """``concat`` of a text template: ``{name}`` is replaced by the column
    ``columns[name]`` cast to string (doubles print as the JVM does)."""
    import re
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(col(columns[piece]).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def tick_json(symbol="symbol", ts="timestampValue", price="price", volume="volume") -> Column:
    """JSON text of one tick, as produced by the tick generator."""
    return F.to_json(F.struct(col(symbol).alias("symbol"), col(ts).alias("timestampValue"),
                              col(price).alias("price"), col(volume).alias("volume")))


def arrival_position(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """Place of a message in a source of several topics, as one text whose order
    is the order of (topic, partition, offset): the numbers have fixed widths
    and the blank sorts before every character of a topic name."""
    return F.concat_ws(" ", F.col(topic), F.lpad(F.col(partition).cast("string"), 10, "0"),
                       F.lpad(F.col(offset).cast("string"), 20, "0"))
