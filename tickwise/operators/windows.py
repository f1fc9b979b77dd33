"""Row-count windows per symbol (W1 ``moving_avg_rows``) and running marks.

``AVG(x) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN n-1 PRECEDING AND
CURRENT ROW)`` is one sort task per symbol in Spark: a symbol holding a third of
all ticks would be one task over a third of the data.  :func:`moving_avg_rows`
computes the same frame with bounded tasks by splitting a symbol into *chunks*
of consecutive ticks:

1. a chunk is a prefix of the timestamp text (month, day, hour, minute,
   second), or a range of the tie-breaker within one timestamp, or, for windows
   in arrival order, a range of the tie-breaker alone.  Each is monotone in the
   window's order, so the chunks of a symbol are consecutive ranges of it;
2. the last ``n-1`` ticks of each (symbol, chunk) are found with a
   ``row_number() <= n-1`` filter, which Spark runs as a partial
   ``WindowGroupLimit`` *before* the shuffle: only ``n-1`` rows per chunk and
   map task are exchanged;
3. these tail rows are numbered along the symbol; each chunk's first tail row
   asks for the ``n-1`` numbers before its own, an equi-join on (symbol,
   number): exactly the ``n-1`` ticks preceding the chunk, however short the
   chunks in between are;
4. these carried rows are unioned with the ticks and the frame is evaluated
   per (symbol, chunk); carried rows are dropped afterwards.

Which symbols are split (``split="auto"``, the default): one aggregation counts
the ticks per symbol; symbols with more ticks than one task should sort
(``hot_rows``; by default ``spark.sql.files.maxPartitionBytes`` / 64 bytes, and
at least 32 windows, so that the tails stay a small part of a symbol) are
hot.  Only for these a second aggregation counts the ticks per second and takes
the coarsest prefix whose *largest* chunk stays within the target, so a burst
is cut as finely as it needs.  The hot symbols are written as a small table and
joined null-safely: by broadcast while they are few, else by shuffle.
``split=True`` chunks every symbol by ``chunk_chars``; ``split=False`` is the
plain window.

The result equals the plain per-symbol window in every mode; the tie-breaker
columns must make the order total (the source ordered by timestamp only, which
is nondeterministic on ties).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_CHARS = 13   # "yyyy-MM-dd HH": one chunk per symbol and hour
TICK_BYTES = 64            # rough size of one tick row, for the task target
WINDOWS_PER_CHUNK = 32     # a chunk is aimed to hold at least so many windows
BROADCAST_KEYS = 10_000    # hot symbols joined by broadcast at most

# Prefixes of "yyyy-MM-dd HH:mm:ss": month, day, hour, minute, second.
PREFIXES = (7, 10, 13, 16, 19)
WHOLE = 99                 # the whole timestamp text and a range of the tie-breaker

CHUNK = "_tw_chunk"
_CARRY = "_tw_carry"
_N = "_tw_number"
_WIDTH = "_tw_width"
_STEP = "_tw_step"
_HOT = "_tw_hot"


def task_rows(spark) -> int:
    """Ticks one task should sort: a file split's worth of tick rows."""
    size = str(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")).strip().lower()
    m = re.match(r"^(\d+)\s*([kmgt]?)i?b?$", size)
    if not m:
        return (128 << 20) // TICK_BYTES
    num = int(m.group(1)) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[m.group(2)]
    return max(num // TICK_BYTES, 1)


def time_text(c) -> Column:
    """Timestamp text without the quotes it still has in a parsed message."""
    return F.trim(F.translate(F.col(c).cast("string"), '"', " "))


def hot_keys(df: DataFrame, key: str, time_col: str | None, tie: str | None, target: int) -> DataFrame | None:
    """``(key, width, step)`` of the symbols with more than ``target`` ticks,
    or ``None`` when there are none.  ``width``: prefix of the timestamp text a
    chunk is cut by (``WHOLE``: the whole text; 0: none), ``step``: length of
    the tie-breaker ranges inside it."""
    from ..session import new_path
    spark = df.sparkSession
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > target)
    if counts.isEmpty():
        return None
    path = new_path(spark, "hot-counts")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    hot = counts.select(F.col(key).alias(_HOT), "n")
    rows = df.join(small(hot.select(_HOT)), F.col(key).eqNullSafe(F.col(_HOT)), "left_semi")
    ids = F.col(tie).cast("long") if tie else F.lit(None).cast("long")
    span = (F.max("hi") - F.min("lo") + 1).cast("double")
    if time_col is None:
        sized = (rows.groupBy(F.col(key).alias(_HOT))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(ids).alias("lo"), F.max(ids).alias("hi"))
                 .groupBy(_HOT).agg(F.lit(0).alias(_WIDTH),
                                    F.greatest(F.lit(target), F.ceil(span * target / F.max("n"))).alias(_STEP)))
    else:
        seconds = (rows.groupBy(F.col(key).alias(_HOT), F.substring(time_text(time_col), 1, PREFIXES[-1]).alias("s"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min(ids).alias("lo"), F.max(ids).alias("hi")))
        step = F.when(F.col("n") > target, F.greatest(
            F.lit(1.0), F.floor((F.col("hi") - F.col("lo") + 1).cast("double") * target / F.col("n"))))
        per_second = seconds.withColumn("step", step)
        cuts = F.array(*[F.struct(F.lit(w).alias("w"), F.substring("s", 1, w).alias("p")) for w in PREFIXES])
        largest = (per_second.select(_HOT, "n", "step", F.explode(cuts).alias("c"))
                   .groupBy(_HOT, "c.w", "c.p").agg(F.sum("n").alias("n"), F.min("step").alias("step"))
                   .groupBy(_HOT, "w").agg(F.max("n").alias("n"), F.min("step").alias("step")))
        sized = largest.groupBy(_HOT).agg(
            F.coalesce(F.min(F.when(F.col("n") <= target, F.col("w"))), F.lit(WHOLE)).alias(_WIDTH),
            F.coalesce(F.min("step"), F.lit(float(target))).alias(_STEP))
    path = new_path(spark, "hot-keys")
    sized = sized.select(_HOT, F.col(_WIDTH).cast("int"), F.col(_STEP).cast("long"))
    sized.write.parquet(path)
    return spark.read.schema(sized.schema).parquet(path)


def small(hot: DataFrame) -> DataFrame:
    """Broadcast hint while the hot symbols are few."""
    return F.broadcast(hot) if hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else hot


def moving_avg_rows(df: DataFrame, n: int, key: str = "symbol",
                    order: Sequence[str] = ("timestampvalue", "tick_id"),
                    values: Sequence[str] = ("price", "volume"),
                    outputs: Sequence[str] = ("avgprice", "avgvolume"),
                    split: bool | str = "auto",
                    chunk_chars: int = DEFAULT_CHUNK_CHARS,
                    hot_rows: int | None = None,
                    time_col: str | None = "timestampvalue",
                    keep_chunk: bool = False) -> DataFrame:
    """Append ``AVG(v) OVER (PARTITION BY key ORDER BY order ROWS n-1
    PRECEDING)`` for each value column.

    ``time_col`` is the timestamp text the chunks are cut from when it is part
    of the order; the last order column is the tie-breaker.  Order columns
    before them (e.g. a micro-batch id) are part of every chunk, so chunks stay
    contiguous ranges of the order.  ``keep_chunk`` keeps the chunk column.
    """
    if n < 1:
        raise ValueError("window size must be >= 1")
    order = list(order)
    avgs = lambda w: [F.avg(F.col(v).cast("double")).over(w).alias(o)
                      for v, o in zip(values, outputs)]

    def plain() -> DataFrame:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(-(n - 1), 0)
        out = df.select("*", *avgs(w))
        return out.withColumn(CHUNK, F.lit("")) if keep_chunk else out

    if split is False or n == 1:
        return plain()
    time_col = time_col if time_col in order else None
    tie = order[-1] if order[-1] != time_col else None
    lead = [F.col(c).cast("string") for c in order if c not in (time_col, tie)]
    raw = F.col(time_col).cast("string") if time_col else F.lit("")
    # a leading quote moves the prefix by one: quoted and bare texts sort apart
    prefix = raw.substr(F.lit(1), F.col(_WIDTH) + F.when(raw.startswith('"'), 1).otherwise(0))
    ids = F.floor(F.col(tie) / F.col(_STEP)).cast("string") if tie else F.lit("")
    part = (F.when(F.col(_WIDTH) == 0, ids)
            .when(F.col(_WIDTH) == WHOLE, F.concat_ws("|", raw, ids)).otherwise(prefix))
    cut = F.concat_ws("|", *lead, F.coalesce(part, F.lit("-")))

    if split == "auto":
        target = max(hot_rows or task_rows(df.sparkSession), WINDOWS_PER_CHUNK * n if hot_rows is None else 1)
        hot = hot_keys(df, key, time_col, tie, target)
        if hot is None:
            return plain()
        marked = df.join(small(hot), F.col(key).eqNullSafe(F.col(_HOT)), "left").drop(_HOT)
    else:
        marked = df.withColumn(_WIDTH, F.lit(chunk_chars if time_col else 0)).withColumn(_STEP, F.lit(1 << 20))
    base = marked.withColumn(CHUNK, F.when(F.col(_WIDTH).isNull(), F.lit("")).otherwise(cut))
    slim = base.where(F.col(_WIDTH).isNotNull()).select(key, CHUNK, *order, *values)
    base = base.drop(_WIDTH, _STEP)

    # (2) last n-1 ticks of every (key, chunk): partial top-k before the shuffle
    w_desc = Window.partitionBy(key, CHUNK).orderBy(*[F.col(c).desc() for c in order])
    tails = slim.withColumn(_N, F.row_number().over(w_desc)).where(F.col(_N) <= n - 1)

    # (3) tail rows numbered along the key; a chunk's first one asks for the n-1 before it
    w_key = Window.partitionBy(key).orderBy(*[F.col(c).asc() for c in order])
    before = F.lag(F.struct(F.col(CHUNK).alias("c"))).over(w_key)
    numbered = tails.select(key, CHUNK, *order, *values, F.row_number().over(w_key).alias(_N),
                            (before.isNotNull() & ~before["c"].eqNullSafe(F.col(CHUNK))).alias("_first"))
    asked = (numbered.where("_first")
             .select(F.col(key).alias("_k"), F.col(CHUNK).alias("_c"),
                     F.explode(F.sequence(F.greatest(F.col(_N) - (n - 1), F.lit(1)), F.col(_N) - 1)).alias("_a")))
    carried = (asked.join(numbered, F.col("_k").eqNullSafe(F.col(key)) & (F.col("_a") == F.col(_N)))
               .select(key, F.col("_c").alias(CHUNK), *order, *values, F.lit(True).alias(_CARRY)))

    # (4) frame per (key, chunk) over ticks + carried rows
    both = base.withColumn(_CARRY, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(key, CHUNK).orderBy(*order).rowsBetween(-(n - 1), 0)
    out = both.select("*", *avgs(w)).where(~F.col(_CARRY)).drop(_CARRY)
    return out if keep_chunk else out.drop(CHUNK)


def running_first_last(df: DataFrame, ts: str = "timestampvalue") -> DataFrame:
    """First timestamp of a poll result ordered by ``ts`` and the running
    maximum up to each row (``first_ts``, ``last_ts``), as the alert digest
    subject uses them.

    No single-partition window: the first value is a scalar subquery
    (``min``, partial aggregation on every task), and along an ascending ``ts``
    order the running maximum of ``ts`` is the row's own ``ts``.
    """
    first = df.select(F.min(ts)).scalar()
    return df.select("*", first.alias("first_ts"), F.col(ts).alias("last_ts"))
