"""Windowed, keyed export of a model table to an export dataset, with a run log.

Re-aimed from a remote-warehouse share: the rows whose ``time_column`` falls in
``[time_start, time_end)`` are written into the export location -- overwritten on a full
refresh, otherwise merged by the unique key with delete+insert. Every sync appends one
row to a run log, which is queried newest first.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetrail.functions.literals import typed_lit
from pyspark.sql import types as T

from codetrail.operators import upsert
from codetrail.session import ensure_conf, path_exists

LOG_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType(), False),
    T.StructField("time_column", T.StringType(), False),
    T.StructField("unique_key_columns", T.ArrayType(T.StringType()), False),
    T.StructField("time_start", T.TimestampType()),
    T.StructField("time_end", T.TimestampType()),
    T.StructField("full_refresh", T.BooleanType(), False),
    T.StructField("rows_synced", T.LongType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])


class ExportSkipped(ValueError):
    """The model is not configured for export (not configured, not enabled, wrong materialization)."""


@dataclass(frozen=True)
class ExportWindow:
    time_column: str
    unique_key: list[str]
    time_start: dt.datetime | None
    time_end: dt.datetime
    full_refresh: bool


def resolve_window(meta: dict | None, materialized: str, model_unique_key, as_of: dt.datetime,
                   is_incremental: bool, full_refresh: bool | None = None, time_start=None, time_end=None,
                   unique_key=None) -> ExportWindow:
    """Choose the window and key of a sync.

    - skipped unless ``meta['export']`` is a mapping with ``enabled is True`` and the model is
      materialized as ``incremental`` or ``table``;
    - an explicit argument wins; otherwise an incremental run uses ``time_start_incremental``
      (falling back to ``time_start``) and a full refresh uses ``time_start``;
    - ``time_end`` defaults to the run instant; the key defaults to the model key;
    - full refresh: always for a table model, else the explicit flag, else a non-incremental run.
    Values may be datetimes or callables of ``as_of``.
    """
    cfg = (meta or {}).get("export") if isinstance(meta, dict) else None
    if not isinstance(cfg, dict):
        raise ExportSkipped("export is not configured")
    if cfg.get("enabled") is not True:
        raise ExportSkipped("export is not enabled")
    if materialized not in ("incremental", "table"):
        raise ExportSkipped(f"materialization {materialized!r} is not incremental/table")
    if materialized == "table":
        full_refresh = True
    elif full_refresh is None:
        full_refresh = not is_incremental

    def ev(v):
        return v(as_of) if callable(v) else v

    if time_start is None:
        time_start = cfg.get("time_start")
        if not full_refresh and cfg.get("time_start_incremental") is not None:
            time_start = cfg["time_start_incremental"]
    if time_end is None:
        time_end = cfg.get("time_end", as_of)
    key = unique_key or cfg.get("unique_key_columns") or model_unique_key
    key = [key] if isinstance(key, str) else list(key)
    return ExportWindow(cfg.get("time_column") or "", key, ev(time_start), ev(time_end), bool(full_refresh))


def window_rows(df: DataFrame, w: ExportWindow, partition_by: str | None = None) -> DataFrame:
    """Rows of the window; a missing start means no lower bound.

    ``partition_by``: a date column that holds the time column's date; its bounds are added, so
    only the window's directories are read.
    """
    c = F.col(f"`{w.time_column}`")
    cond = c < typed_lit(w.time_end)
    if w.time_start is not None:
        cond = (c >= typed_lit(w.time_start)) & cond
    if partition_by and partition_by != w.time_column and isinstance(df.schema[partition_by].dataType, T.DateType):
        day = F.col(f"`{partition_by}`")
        cond = cond & (day <= typed_lit(w.time_end.date()))
        if w.time_start is not None:
            cond = cond & (day >= typed_lit(w.time_start.date()))
    return df.where(cond)


def sync(spark: SparkSession, df: DataFrame, source_table: str, w: ExportWindow, dest: str, log_path: str,
         as_of: dt.datetime, partition_by: str | None = None) -> int:
    """Write the window to ``dest`` and append a run-log row. Returns rows synced: those of the
    window in the source, not what the destination holds."""
    ensure_conf(spark)
    rows = window_rows(df, w, partition_by)
    if w.full_refresh:
        upsert.full_refresh(spark, rows, dest, partition_by)
        n = spark.read.schema(rows.schema).parquet(dest).count()  # just what was written; from file footers
    else:
        n = upsert.delete_insert(spark, rows, dest, w.unique_key, partition_by).rows
    log_row(spark, source_table, w, n, as_of).write.mode("append").parquet(log_path)
    return int(n)


def export_changes(spark: SparkSession, df: DataFrame, dest: str, unique_key, partition_by: str, as_of: dt.datetime) -> DataFrame:
    """K10 by content: send the rows that are new or differ since the last export, and the keys that vanished.

    A state table beside the export holds (key, partition, digest of the row) of what was sent. The
    differences to it are written to ``<dest>_changes`` (``op`` upsert or delete, one directory for
    each run) and applied to ``dest``; partitions without a change are not rewritten. Returns the
    run's changes. A run that failed is run again from the same state: its directory is replaced,
    and applying its changes twice leaves the same table.
    """
    ensure_conf(spark)
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    upsert.assert_no_null_keys(df, [*keys, partition_by])
    named = [F.col(f"`{c}`") for c in df.columns]
    columns = [F.col(f"`{k}`") for k in keys] + ([] if partition_by in keys else [F.col(f"`{partition_by}`")])
    digest = F.unhex(F.sha2(F.to_json(F.struct(*named)), 256)).alias("_digest")
    # Keys and digests are narrow and are compared several times: decoded and digested once.
    current = df.select(*columns, digest).persist(StorageLevel.MEMORY_AND_DISK)
    old = None
    try:
        state_path, run = f"{dest}_state", f"{as_of:%Y%m%dT%H%M%S}"
        version = spark.read.schema(f"{STATE_VERSION} string").parquet(state_path) if path_exists(spark, state_path) else None
        last = None if version is None else version.agg(F.max(STATE_VERSION)).first()[0]
        if last is None:
            before = current.limit(0)
        else:
            before = spark.read.schema(current.schema).parquet(f"{state_path}/{STATE_VERSION}={last}")
        fresh = df.withColumn("_digest", digest).join(before.select(*keys, "_digest"), [*keys, "_digest"], "left_anti").select(*named)
        # old rows of changed keys, and of keys that are not there any more, each in the partition that holds it
        old = before.join(current.select(*keys, "_digest"), [*keys, "_digest"], "left_anti").select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        vanished = old.join(current.select(*keys), keys, "left_anti")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in vanished.columns]
        deletes = vanished.select(*columns, *empty).select(*named)
        out = f"{dest}_changes/run={run}"
        fresh.withColumn("op", F.lit("upsert")).unionByName(deletes.withColumn("op", F.lit("delete"))).write.mode("overwrite").parquet(out)
        changes = spark.read.schema(fresh.withColumn("op", F.lit("upsert")).schema).parquet(out)
        upsert.apply_changes(spark, changes.where("op = 'upsert'").drop("op"), old, dest, keys, partition_by)
        current.write.mode("overwrite").parquet(f"{state_path}/{STATE_VERSION}={run}")
        return changes
    finally:
        current.unpersist()
        if old is not None:
            old.unpersist()


STATE_VERSION = "version"


def log_row(spark: SparkSession, source_table: str, w: ExportWindow, rows_synced: int, as_of: dt.datetime) -> DataFrame:
    """One run-log row, built from typed literals (instants are read in the session zone)."""
    vals = {
        "source_table": F.lit(source_table),
        "time_column": F.lit(w.time_column),
        "unique_key_columns": F.array(*[F.lit(k) for k in w.unique_key]),
        "time_start": typed_lit(w.time_start) if w.time_start is not None else F.lit(None),
        "time_end": typed_lit(w.time_end),
        "full_refresh": F.lit(bool(w.full_refresh)),
        "rows_synced": F.lit(int(rows_synced)),
        "created_at": typed_lit(as_of),
    }
    return spark.range(1).select(*[vals[f.name].cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields])


def runs(spark: SparkSession, log_path: str, source_table: str | None = None) -> DataFrame:
    """Run history, newest first."""
    df = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    if source_table is not None:
        df = df.where(F.col("source_table") == F.lit(source_table))
    return df.orderBy(F.desc("created_at"))


def latest_runs(spark: SparkSession, log_path: str, n: int = 1, source_table: str | None = None) -> DataFrame:
    """Top-n most recent runs (ORDER BY ... LIMIT n -> TakeOrderedAndProject)."""
    return runs(spark, log_path, source_table).limit(n)


@dataclass(frozen=True)
class ExportedModel:
    """A model table that is exported after its run: its key, materialization and ``meta``."""

    table: str
    path: str
    unique_key: list[str]
    meta: dict
    materialized: str = "incremental"
    partition_by: str | None = None


def sync_models(spark: SparkSession, models: list[ExportedModel], dest_root: str, as_of: dt.datetime, is_incremental: bool,
                full_refresh: bool | None = None, time_start=None, time_end=None) -> dict[str, int]:
    """The post-run step, and the manual re-sync when a window or ``full_refresh`` is given.

    Models that are not configured for export are left out. Returns the rows synced by model.
    """
    out = {}
    for m in models:
        dest = f"{dest_root.rstrip('/')}/{m.table}"
        try:
            # a first export has nothing to merge into
            w = resolve_window(m.meta, m.materialized, m.unique_key, as_of, is_incremental and path_exists(spark, dest),
                               full_refresh, time_start, time_end)
        except ExportSkipped:
            continue
        out[m.table] = sync(spark, spark.read.parquet(m.path), m.table, w, dest, f"{dest_root.rstrip('/')}/_runs", as_of, m.partition_by)
    return out
