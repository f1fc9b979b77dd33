"""The batch ratio job: raw ticks -> transformed rows -> historical ratio.

One run:

1. read the raw tick table and the transformed table written by earlier runs;
2. Q1 ``ratio_query`` over the ticks not yet transformed (J1 + W1 + P6) and
   append the rows to the transformed table (optionally partitioned by
   symbol);
3. re-read the whole transformed table, Q2 ``hist_ratio_query`` (rounded,
   key-value-store form, or unrounded, wide-store form);
4. write the history as a new run folder ``run=<id>`` of the history table:
   either the new result alone (overwrite semantics) or the new result merged
   over the previous run, latest per key (upsert semantics, K3).

Readers take the latest run (:func:`read_history`), so a reader never sees a
half-written history and no path is overwritten while it is read.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import TOD_WIDTH
from ..operators.history import hist_ratio_query, ratio_query
from ..session import new_path
from ..sources.sinks import RUN, append_partitioned_by_symbol, append_table, read_or_none, read_run, runs_of, upsert_last_wins


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest run of a run-versioned history table (or the table itself
    when it has no runs)."""
    runs = runs_of(spark, path)
    return read_run(spark, path, runs[-1]) if runs else read_or_none(spark, path)


def one_row_per_key(df: DataFrame, keys=("symbol", "timestampvalue")) -> DataFrame:
    """The history table's primary key: when the faithful Q2 returns several
    rows for a key (same ``histratio``, different latest-row metrics), keep
    one, deterministically (the largest by the remaining columns), as the
    keyed store kept one of them."""
    from pyspark.sql import functions as F
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_r"))
              .select(*keys, *[f"_r.{c}" for c in others]))


def _write_history(spark: SparkSession, trans: DataFrame, history_path: str, width: int,
                   rounded: bool, upsert: bool, run_id: int) -> None:
    hist = one_row_per_key(hist_ratio_query(trans, width, rounded=rounded))
    target = f"{history_path.rstrip('/')}/{RUN}={run_id}"
    previous = read_history(spark, history_path) if upsert else None
    upsert_last_wins(spark, previous, hist, target)


def run_batch_ratio_job(spark: SparkSession, ticks_path: str, transformed_path: str,
                        history_path: str, n: int, width: int = TOD_WIDTH,
                        rounded: bool = True, partitioned: bool = False,
                        upsert: bool = False, run_id: int | None = None) -> int:
    """Run the job once over parquet folders; returns the history run id."""
    run_id = int(run_id if run_id is not None else time.time() * 1000)
    ticks = spark.read.parquet(ticks_path)
    done = read_or_none(spark, transformed_path)
    rows = ratio_query(ticks, done, n)
    if partitioned:
        append_partitioned_by_symbol(rows, transformed_path)
    else:
        append_table(rows, transformed_path)
    _write_history(spark, spark.read.parquet(transformed_path), history_path, width, rounded,
                   upsert, run_id)
    return run_id


STATE_PARTS = ("index", "groups", "latest", "log")      # written in this order
LOG = "rows long"


class RunState:
    """What an incremental run keeps for the next one, in ``<path>/run=<id>``:
    index rows of its new timestamps (:mod:`operators.delta_index`), merged
    groups and the rows at latest timestamps (see ``operators.history``), and
    at last the number of transformed rows there are, which makes it valid."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def folder(self, run: int, part: str) -> str:
        return f"{self.path}/{RUN}={run}/{part}"

    def valid_runs(self) -> list[int]:
        return [r for r in runs_of(self.spark, self.path)
                if read_or_none(self.spark, self.folder(r, "log"), LOG) is not None]

    def fits(self, run: int, done: DataFrame | None) -> bool:
        """Whether the transformed table still has the rows it had then."""
        known = self.spark.read.schema(LOG).parquet(self.folder(run, "log")).first()[0]
        return known == (0 if done is None else done.count())

    def read(self, run: int, part: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(run, part))

    def write(self, run: int, part: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(self.folder(run, part))
        return self.read(run, part, rows.schema)


def run_incremental_ratio_job(spark: SparkSession, ticks_path: str, transformed_path: str, history_path: str,
                              state_path: str, n: int, width: int = TOD_WIDTH, rounded: bool = True,
                              run_id: int | None = None) -> int:
    """The batch ratio job at the cost of its new rows: J1 looks ticks up in
    the index of transformed timestamps, Q2 merges the new rows into the stored
    groups; the transformed table is appended to, its rows are not read (but
    for their number, from the file footers).  Where the state does not fit the
    table (first run, a run that failed after its append, rows added by
    another job) it is made anew from the whole table."""
    from pyspark.sql import functions as F

    from .. import schemas as S
    from ..operators.delta_index import delta_by_index, index_rows, read_index
    from ..operators.history import (GROUPS, TRANSFORMED_COLS, group_partials, hist_ratio_from_groups, merged_groups,
                                     rows_at_latest)
    run_id = int(run_id if run_id is not None else time.time() * 1000)
    state, done = RunState(spark, state_path), read_or_none(spark, transformed_path)
    runs = [r for r in state.valid_runs() if r < run_id]
    row_schema = spark.createDataFrame([], S.TRANSFORMED).select(*TRANSFORMED_COLS).schema
    if runs and state.fits(runs[-1], done):
        last = runs[-1]
        groups, latest = state.read(last, "groups", GROUPS), state.read(last, "latest", row_schema)
        known = read_index(spark, [state.folder(r, "index") for r in runs])
        before = state.spark.read.schema(LOG).parquet(state.folder(last, "log")).first()[0]
    else:
        whole = spark.createDataFrame([], row_schema) if done is None else done.select(*TRANSFORMED_COLS)
        rebuilt = new_path(spark, "state")
        index_rows(whole).write.parquet(f"{rebuilt}/index")
        group_partials(whole, width).write.parquet(f"{rebuilt}/groups")
        groups = spark.read.schema(GROUPS).parquet(f"{rebuilt}/groups")
        latest = rows_at_latest(whole, whole.limit(0), groups)
        known, before = read_index(spark, [f"{rebuilt}/index"]), whole.count()
        runs = []

    index_path = new_path(spark, "index")
    known.write.parquet(index_path)
    delta = delta_by_index(spark.read.parquet(ticks_path), spark.read.schema(known.schema).parquet(index_path))
    staged = new_path(spark, "transformed-delta")
    ratio_query(delta, None, n).write.parquet(staged)
    new = spark.read.schema(row_schema).parquet(staged)
    append_table(new, transformed_path)

    # a first index holds all that is known; later ones only what is new
    rows = index_rows(new)
    if not runs:
        rows = rows.unionByName(spark.read.schema(known.schema).parquet(index_path).select(*rows.columns))
    state.write(run_id, "index", rows)
    groups = state.write(run_id, "groups", merged_groups(groups, group_partials(new, width)))
    latest = state.write(run_id, "latest", rows_at_latest(latest, new, groups))
    hist = one_row_per_key(hist_ratio_from_groups(groups, latest, width, rounded))
    upsert_last_wins(spark, None, hist, f"{history_path.rstrip('/')}/{RUN}={run_id}", mode="overwrite")
    total = new.agg((F.count("*") + F.lit(int(before))).alias("rows"))
    state.write(run_id, "log", total)
    return run_id


def create_bucketed_tables(spark: SparkSession, ticks_table: str, transformed_table: str,
                           buckets: int, location: str | None = None) -> None:
    """Create the raw tick and transformed tables, both bucketed (and sorted)
    by ``timestampvalue`` into the same number of buckets, so the delta anti
    join (J1) of every run reads both sides without a shuffle.  The raw table
    is also partitioned by ``batch_id``: the ingest stream overwrites its own
    batch partition, so a replayed micro-batch is not appended twice."""
    from .. import schemas as S
    from pyspark.sql import types as T
    tick_schema = T.StructType(list(S.TICK.fields) + [T.StructField("tick_id", T.LongType()),
                                                      T.StructField("batch_id", T.IntegerType())])
    for name, schema in ((ticks_table, tick_schema), (transformed_table, S.TRANSFORMED)):
        if spark.catalog.tableExists(name):
            continue
        w = (spark.createDataFrame([], schema).write.format("parquet")
             .bucketBy(buckets, "timestampvalue").sortBy("timestampvalue"))
        if "batch_id" in schema.fieldNames():
            w = w.partitionBy("batch_id")
        if location:
            w = w.option("path", f"{location.rstrip('/')}/{name.split('.')[-1]}")
        w.saveAsTable(name)


def run_bucketed_ratio_job(spark: SparkSession, ticks_table: str, transformed_table: str,
                           history_path: str, n: int, width: int = TOD_WIDTH,
                           rounded: bool = True, upsert: bool = False,
                           run_id: int | None = None) -> int:
    """The same run over the bucketed catalog tables: J1 is a sort-merge anti
    join without exchanges; the new rows are inserted with the table's
    bucketing."""
    run_id = int(run_id if run_id is not None else time.time() * 1000)
    ticks, done = spark.table(ticks_table), spark.table(transformed_table)
    rows = ratio_query(ticks.drop("batch_id"), done, n)
    # materialize before inserting into a table the query itself reads
    staged = new_path(spark, "transformed-delta")
    rows.write.parquet(staged)
    spark.read.parquet(staged).select(*spark.table(transformed_table).columns).write.insertInto(
        transformed_table)
    _write_history(spark, spark.table(transformed_table), history_path, width, rounded, upsert,
                   run_id)
    return run_id
