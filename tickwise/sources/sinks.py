"""Table writers of the pipeline (parquet in the shared folder).

* plain appends: raw ticks (``stock_tracker``), transformed rows
  (``stock_transformation_temp``), optionally partitioned by symbol;
* overwrite of the historical table (``stock_transformation``);
* K2 first-wins keyed append (``stock``, ``stock_alert``): a key already in
  the table keeps its row; the check reads only the table partitions of the
  dates present in the batch (rows whose time is no date share one partition);
* K3 last-wins upsert: (table union batch) -> latest row per key, written to a
  new version folder, or appended per micro-batch and resolved by the reader;
* per-micro-batch writes are idempotent: a batch writes its own
  ``batch_id=<id>`` partition with dynamic partition overwrite, so a replayed
  batch replaces its earlier attempt instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

KEYS = ("symbol", "timestampvalue")
DATE = "datevalue"
RUN = "run"          # version column of run-versioned tables (folders run=<id>)
LISTED_DATES = 64    # date folders read one by one; beyond, the table is read and pruned

# Spark's error conditions for a folder that is not there or holds no table yet.
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """``INSERT INTO``: append rows, optionally into partition folders."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_partitioned_by_symbol(df: DataFrame, path: str) -> None:
    """The partitioned form of the transformed table (partition column last).
    Rows are dealt by symbol first: the adaptive rebalance splits a large symbol
    over several tasks and gives many small ones to one, so a symbol gets a file
    per task's share of it, not one per task of the whole job."""
    append_table(df.hint("rebalance", "symbol"), path, ("symbol",))


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the whole table (the historical ratio table after each batch
    run).  ``df`` must not be computed from ``path`` itself."""
    df.write.mode("overwrite").parquet(path)


def read_or_none(spark: SparkSession, path: str, schema=None, **options) -> DataFrame | None:
    """The table at ``path``, or ``None`` where there is none yet; any other
    error is raised."""
    reader = spark.read.options(**options)
    try:
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        return None


def runs_of(spark: SparkSession, path: str) -> list[int]:
    """Version ids of a run-versioned table, by its folder names."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{RUN}=*")
    found = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs_path) or []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found)


def read_run(spark: SparkSession, path: str, run: int, schema=None) -> DataFrame | None:
    return read_or_none(spark, f"{path.rstrip('/')}/{RUN}={int(run)}", schema)


def pinned_run(spark: SparkSession, path: str, pins: str, batch_id: int) -> int | None:
    """The version of the table at ``path`` that micro-batch ``batch_id`` reads:
    the latest at its first attempt, kept in the folder ``pins``, so that a
    replay reads the same version whatever was written since (``None``: the
    table had no version yet)."""
    pin = read_or_none(spark, f"{pins.rstrip('/')}/batch_id={int(batch_id)}", "run long")
    if pin is not None:
        return pin.first()[0]
    runs = runs_of(spark, path)
    run = runs[-1] if runs else None
    write_batch(spark.range(0, 1, 1, 1).select(F.lit(run).cast("long").alias("run")), pins, batch_id)
    return run


def drop_runs_before(spark: SparkSession, path: str, run: int) -> None:
    """Delete the versions below ``run`` of a table this job writes."""
    for old in runs_of(spark, path):
        if old < run:
            p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{RUN}={old}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def version_before(spark: SparkSession, path: str, batch_id: int, schema) -> DataFrame:
    """State written by the micro-batch before ``batch_id`` of a run-versioned
    table (empty when there is none)."""
    earlier = [r for r in runs_of(spark, path) if r < int(batch_id)]
    found = read_run(spark, path, earlier[-1], schema) if earlier else None
    return found if found is not None else spark.createDataFrame([], schema)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Idempotent write of one micro-batch: rows land in ``batch_id=<id>``
    (below any other partition columns) with dynamic partition overwrite."""
    (df.withColumn("batch_id", F.lit(int(batch_id)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by, "batch_id").parquet(path))


def date_of(ts: str = "timestampvalue"):
    """Date of a time text, NULL where it starts with none: the partition of
    the keyed tables, so junk text never becomes a folder name."""
    return F.try_to_timestamp(F.substring(F.col(ts), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def batch_bounds(df: DataFrame, ts: str = "timestampvalue"):
    """(dates, min ts, max ts) of one micro-batch, in one small job: the
    partitions (``None``: no date) and the time range an earlier row with the
    same key can be in."""
    day = date_of(ts)
    r = df.agg(F.collect_set(day).alias("d"), F.max(day.isNull()).alias("n"), F.min(ts).alias("lo"),
               F.max(ts).alias("hi")).first()
    return [*sorted(r["d"] or []), *([None] if r["n"] else [])], r["lo"], r["hi"]


def read_dates(spark: SparkSession, path: str, schema, dates) -> DataFrame:
    """Rows of a ``datevalue``-partitioned table in the given dates only.  The
    listing covers just those folders, not the whole table, which grows with
    every micro-batch."""
    empty = spark.createDataFrame([], schema)
    if len(dates) > LISTED_DATES:
        table = read_or_none(spark, path, schema)
        return empty if table is None else table
    for d in dates:
        folder = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
        part = read_or_none(spark, f"{path.rstrip('/')}/{DATE}={folder}", schema, basePath=path)
        empty = empty if part is None else empty.unionByName(part)
    return empty


def rows_in_bounds(table: DataFrame, bounds, ts: str = "timestampvalue") -> DataFrame:
    """Table rows in the batch's date partitions and time range: partition
    pruning on ``datevalue`` plus parquet min/max skipping on ``ts`` (each
    micro-batch's files cover a narrow time range)."""
    dates, lo, hi = bounds
    days = [d for d in dates if d is not None]
    inside = F.col(DATE).isin(days) & F.col(ts).between(lo, hi) if days and lo is not None else F.lit(False)
    if None in dates:
        other = F.col(ts).isNull() if lo is None else F.col(ts).isNull() | F.col(ts).between(lo, hi)
        inside = inside | (F.col(DATE).isNull() & other)
    return table.where(inside)


def write_batch_to_table(df: DataFrame, table: str, batch_id: int) -> None:
    """Idempotent write of one micro-batch into a catalog table partitioned by
    ``batch_id`` (bucketing of the table is applied by the insert)."""
    import uuid
    spark = df.sparkSession
    cols = [c for c in spark.table(table).columns if c != "batch_id"]
    view = f"_tw_batch_{uuid.uuid4().hex[:12]}"
    df.select(*cols).createOrReplaceTempView(view)
    try:
        # a static partition spec replaces exactly this batch's partition
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) "
                  f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def keyed_schema(schema: T.StructType) -> T.StructType:
    """Schema of a keyed table as written by :func:`first_wins_append`."""
    return T.StructType(list(schema.fields)).add(DATE, T.DateType()).add("batch_id", T.IntegerType())


def first_wins_append(batch: DataFrame, path: str, batch_id: int, schema,
                      keys: Sequence[str] = KEYS, order: str = "tick_id", log=None) -> None:
    """K2: append the batch's first row per key unless the key is already in
    the table from an earlier batch.  The table is partitioned by
    ``datevalue``; only the batch's date folders are listed and only rows in
    its time range are read.  The deduplicated batch is computed once.
    ``log`` (a ``streaming.batch_log.BatchLog``) gets the count and latest time
    of the rows appended."""
    from ..operators.alerts import first_wins
    spark = batch.sparkSession
    b = first_wins(batch, keys, order) if order in batch.columns else batch.dropDuplicates(list(keys))
    b = b.withColumn(DATE, date_of()).persist()
    try:
        bounds = batch_bounds(b)
        existing = rows_in_bounds(read_dates(spark, path, keyed_schema(schema), bounds[0]), bounds)
        seen = existing.where(F.col("batch_id") < int(batch_id)).select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_seen_{k}"))
        new = b.join(seen, same, "left_anti")
        if log is not None:
            new = log.observed(new)
        write_batch(new.select(*[f.name for f in schema.fields if f.name not in (DATE, "batch_id")], DATE),
                    path, batch_id, (DATE,))
        if log is not None:
            log.store()
    finally:
        b.unpersist()


def upsert_last_wins(spark: SparkSession, current: DataFrame | str | None, batch: DataFrame,
                     new_path: str, keys: Sequence[str] = KEYS, seq: str | None = None,
                     mode: str = "errorifexists") -> str:
    """K3: keep the latest row per key of (table union batch) and write it as
    a new version at ``new_path``, a folder other than the current one; the
    caller switches readers to it.  Rows of the batch win over table rows;
    ``seq`` orders rows inside the batch."""
    b = batch.withColumn("_v", F.lit(1))
    b = b.withColumn("_s", F.lit(0)) if seq is None else b.withColumn("_s", F.col(seq)).drop(seq)
    if isinstance(current, str):
        current = spark.read.parquet(current)
    if current is not None:
        b = current.withColumn("_v", F.lit(0)).withColumn("_s", F.lit(0)).select(*b.columns).unionByName(b)
    latest_per_key(b, keys, ("_v", "_s")).write.mode(mode).parquet(new_path)
    return new_path


BUCKET = "bucket"     # partition column of a bucketed table


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(int(buckets))).cast("int")


def upsert_buckets(batch: DataFrame, path: str, buckets: int, keys: Sequence[str] = KEYS,
                   seq: str | None = None) -> list[int]:
    """K3 in place: the table at ``path`` is partitioned by a hash of the keys,
    and only buckets that hold a key of the batch are read and replaced
    (dynamic partition overwrite); rows of the batch win, ``seq`` orders them
    inside it.  The merged buckets are written aside first, so the table is not
    read while it is replaced and a failed run can be repeated.  Returns the
    buckets replaced (at most ``buckets``); the number of buckets must be the
    same on every call.  Null keys are keys like any other."""
    from ..session import new_path
    spark = batch.sparkSession
    rows = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    rows = rows.withColumn("_s", F.lit(0)) if seq is None else rows.withColumnRenamed(seq, "_s")
    changed = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
    if not changed:
        return []
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("_s", BUCKET)]).add(BUCKET, T.IntegerType())
    table = read_or_none(spark, path, schema)
    rows = rows.withColumn("_v", F.lit(1))
    if table is not None:
        old = table.where(F.col(BUCKET).isin(changed)).withColumn("_v", F.lit(0)).withColumn(
            "_s", F.lit(None).cast(rows.schema["_s"].dataType))
        rows = rows.unionByName(old)
    merged, aside = latest_per_key(rows, (*keys, BUCKET), ("_v", "_s")), new_path(spark, "upsert")
    merged.write.parquet(aside)
    (spark.read.schema(merged.schema).parquet(aside).repartition(min(len(changed), buckets), BUCKET)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    return changed


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key, without the order columns."""
    others = [c for c in rows.columns if c not in (*keys, *order)]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r"))
                .select(*keys, *[f"_r.{c}" for c in others]))


def csv_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV sink (header, overwrite), one file per task.  ``files`` merges the
    output into that many files (the source wrote a single file); only for
    outputs known to be small, since it funnels them through ``files`` tasks."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", "true").csv(path)
