"""Streaming forms of the incremental models.

* :func:`start_transactions_stream` (T5): new source files -> trailer decode -> keyed
  delete+insert per micro-batch. The upsert is idempotent, so a micro-batch replayed after
  a failure (same batch id, same files) leaves the same table: exactly-once results with
  the checkpoint in the shared folder.
* ``dedup=True`` (T6): transactions delivered twice in one micro-batch are dropped inside it,
  after the filters; one delivered again later, however late, meets its old row in the keyed
  upsert. No state is kept and no row is ever too late. ``target_days`` bounds how far back the
  upsert looks for old rows.
* :func:`run_dedup_streams` (T6 with state): keys seen lately are kept in the RocksDB state store, so a
  row delivered again never reaches the table; rows older than the watermark go to a side table.
* :func:`start_daily_stream` (T7): exact ``COUNT(DISTINCT)`` is not available on streams, so
  each micro-batch recomputes the *days it touched* from the written tables. Transactions,
  transfers and prices are one stream of arrivals, and each arrival touches its day: a price that
  comes after its day's batch repairs that day's fees. The touched days are kept in a table, the
  day log (day, source, batch), and a batch recomputes what its log rows say: transfers of days
  touched by transactions or transfers are re-attributed (a transfer shares its transaction's block
  and so its ``block_date``), and the daily metric of all touched days is replaced, including days
  that became empty. All three sources are read inside the batch, as they are by then.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from codetrail.functions.literals import isin, typed_lit

from codetrail import schemas
from codetrail.functions.windows import Floors
from codetrail.operators import attribution, metrics, upsert
from codetrail.plans.models import ModelPaths
from codetrail.session import ensure_conf, join_as_dealt, path_exists
from codetrail.sources.catalog import read_table


#: Files of one micro-batch: a backlog is taken in parts, since the batch is kept during its write.
MAX_FILES = 1000


def read_stream(spark: SparkSession, source_dir: str, schema, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    ensure_conf(spark)
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(source_dir)


def read_transactions_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    return read_stream(spark, source_dir, schemas.TRANSACTIONS, max_files_per_trigger)


def attributed_stream(stream: DataFrame, floors: Floors = Floors()) -> DataFrame:
    return attribution.attribute_transactions(stream, floors, None)


def _upsert_batch(rows: DataFrame, target: str, dedup: bool, as_of_days: int | None) -> upsert.UpsertResult:
    """One micro-batch of attributed transactions into the table."""
    arrived = rows.persist(StorageLevel.MEMORY_AND_DISK)   # a micro-batch is decoded again for each use
    try:
        if dedup:  # the latest of differing duplicates stays, whatever the order of arrival
            rows = upsert.dedupe_repeated(arrived, schemas.TX_KEY, ["block_time", "block_number"])
        predicate = None
        if as_of_days is not None:
            last = rows.agg(F.max("block_date")).first()[0]
            predicate = None if last is None else F.col("block_date") >= typed_lit(last - dt.timedelta(days=as_of_days))
        return upsert.delete_insert(rows.sparkSession, rows, target, schemas.TX_KEY, schemas.TX_PARTITION, target_predicate=predicate)
    finally:
        arrived.unpersist()


def _start(stream: DataFrame, write_batch, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_transactions_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                              floors: Floors = Floors(), dedup: bool = False,
                              max_files_per_trigger: int | None = MAX_FILES, available_now: bool = True,
                              target_days: int | None = None) -> StreamingQuery:
    """Stream transactions into ``transactions_attributed`` with keyed upserts.

    ``target_days``: old rows of a micro-batch's keys are looked for in the days up to so many
    before its latest one; None looks at the whole table (exact).
    """
    out = attributed_stream(read_transactions_stream(spark, source_dir, max_files_per_trigger), floors)

    def write_batch(rows: DataFrame, _: int) -> None:
        _upsert_batch(rows, target, dedup, target_days)

    return _start(out, write_batch, checkpoint, available_now)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _content() -> Column:
    """Digest of a whole attributed row."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in schemas.TX_ATTRIBUTED_COLUMNS]), {"ignoreNullFields": "false"}), 256)


def start_stateful_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str, floors: Floors = Floors(),
                          delay: str = "2 days", max_files_per_trigger: int | None = MAX_FILES,
                          available_now: bool = True) -> StreamingQuery:
    """T6 with state: a row delivered again within ``delay`` of event time is dropped before the table is touched.

    ``dropDuplicatesWithinWatermark`` on (hash, content) keeps two digests a row in the RocksDB state
    store, bounded by the delay. Versions of a transaction that differ in content pass it and meet in
    the keyed upsert: of one micro-batch the latest by (block_time, block_number, other columns) stays,
    and the version of a later micro-batch replaces it. Rows older than the watermark are left out
    here; :func:`start_late_stream` takes them.
    """
    out = attributed_stream(read_transactions_stream(spark, source_dir, max_files_per_trigger), floors).withColumn("_content", _content())
    out = out.withWatermark("block_time", delay).dropDuplicatesWithinWatermark([*schemas.TX_KEY, "_content"]).drop("_content")

    def write_batch(rows: DataFrame, _: int) -> None:
        _upsert_batch(rows, target, True, None)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)   # the query takes its settings when it starts
    try:
        return _start(out, write_batch, checkpoint, available_now)
    finally:
        spark.conf.set(_PROVIDER, before)


def start_late_stream(spark: SparkSession, source_dir: str, target: str, late: str, checkpoint: str, floors: Floors = Floors(),
                      max_files_per_trigger: int | None = MAX_FILES, available_now: bool = True) -> StreamingQuery:
    """Rows that the stateful stream left out as too late: into the side table ``late``, none is lost.

    Stateless, over the same source with a checkpoint of its own. An arrival whose hash the table does
    not hold on its day is late; a file that the stateful stream has not taken yet looks the same, so
    :func:`read_with_late` prefers the table's row.
    """
    out = attributed_stream(read_transactions_stream(spark, source_dir, max_files_per_trigger), floors)

    def write_batch(rows: DataFrame, _: int) -> None:
        session = rows.sparkSession
        days = [r[0] for r in rows.select("block_date").distinct().limit(upsert.MAX_PARTITIONS + 1).collect()]
        if len(days) > upsert.MAX_PARTITIONS:
            raise upsert.TooManyPartitions(f"a micro-batch holds more than {upsert.MAX_PARTITIONS} days")
        if not days:
            return
        if path_exists(session, target):
            held = read_table(session, target, schemas.TX_ATTRIBUTED).where(isin(F.col("block_date"), days))
            rows = rows.join(held.select("hash", "block_date"), ["hash", "block_date"], "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])
        _upsert_batch(rows, late, True, None)

    return _start(out, write_batch, checkpoint, available_now)


def run_dedup_streams(spark: SparkSession, source_dir: str, target: str, late: str, checkpoint: str, floors: Floors = Floors(),
                      delay: str = "2 days", max_files_per_trigger: int | None = MAX_FILES) -> None:
    """Take what has arrived: the stateful stream first, then what it left out."""
    start_stateful_stream(spark, source_dir, target, f"{checkpoint}/main", floors, delay, max_files_per_trigger).awaitTermination()
    start_late_stream(spark, source_dir, target, late, f"{checkpoint}/late", floors, max_files_per_trigger).awaitTermination()


def read_with_late(spark: SparkSession, target: str, late: str) -> DataFrame:
    """The table and the late rows whose hash it does not hold: one row a hash, as the batch form has them."""
    columns = [F.col(f"`{c}`") for c in schemas.TX_ATTRIBUTED_COLUMNS]
    main = read_table(spark, target, schemas.TX_ATTRIBUTED).select(*columns)
    if not path_exists(spark, late):
        return main
    side = read_table(spark, late, schemas.TX_ATTRIBUTED)
    return main.unionByName(side.join(main.select("hash"), "hash", "left_anti").select(*columns))


#: The day log: which source touched which day in which micro-batch.
DAY_LOG = T.StructType([T.StructField("day", T.DateType()), T.StructField("source", T.StringType()), T.StructField("batch", T.LongType())])


def day_log(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, DAY_LOG)


def log_days(spark: SparkSession, path: str, batch: int, touched: DataFrame) -> list:
    """Write the touched ``(day, source)`` of a micro-batch and return them as rows. A batch that is run again replaces its rows."""
    (touched.where("day is not null").distinct().withColumn("batch", F.lit(batch).cast("long")).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))
    found = day_log(spark, path).where(F.col("batch") == batch).limit(upsert.MAX_PARTITIONS + 1).collect()
    if len(found) > upsert.MAX_PARTITIONS:
        raise upsert.TooManyPartitions(f"batch {batch} touches more than {upsert.MAX_PARTITIONS} days")
    return found


def _in_days(column: str, days: list) -> Column:
    """Instants of the given days: a range that reaches the scan, and one IN list."""
    ts = F.col(column)
    first, last = (dt.datetime.combine(x, dt.time()) for x in (min(days), max(days) + dt.timedelta(days=1)))
    return (ts >= typed_lit(first)) & (ts < typed_lit(last)) & isin(F.to_date(ts), days)


def recompute_days(spark: SparkSession, days: list, transfers_source: DataFrame, prices: DataFrame,
                   paths: ModelPaths, chain: str = "celo", floors: Floors = Floors(), attribute: list | None = None) -> None:
    """Rebuild transfers_attributed for the days ``attribute`` (default: all) and the daily metric for ``days`` (dates) from the tables."""
    if not days:
        return
    attribute = days if attribute is None else attribute
    ta = read_table(spark, paths.transactions_attributed, schemas.TX_ATTRIBUTED)
    in_days = lambda some: isin(F.col("block_date"), some)
    if attribute:
        tr = attribution.select_transfers(transfers_source.where(in_days(attribute)), chain, floors)
        keys = attribution.attribution_keys(ta.where(in_days(attribute)), floors)
        counts = attribution.rows_by_day(tr, upsert.MAX_PARTITIONS)   # a left join keeps every transfer, so its days are theirs
        with join_as_dealt(spark):
            upsert.replace_partitions(spark, attribution.attribute_by_day(tr, keys, counts), paths.transfers_attributed,
                                      schemas.TRANSFER_PARTITION, attribute, found=set(counts))
    tra = read_table(spark, paths.transfers_attributed, schemas.TRANSFERS_ATTRIBUTED) if path_exists(spark, paths.transfers_attributed) \
        else spark.createDataFrame([], schemas.TRANSFERS_ATTRIBUTED)
    dm = metrics.daily_metrics(tra.where(in_days(days)), ta.where(in_days(days)), prices.where(_in_days("timestamp", days)), chain, floors, None)
    # Replace the whole days of the list: a (day, code), or a day, that vanished is removed too.
    upsert.replace_where(spark, dm, paths.daily_metric, _in_days("day", days))


def start_daily_stream(spark: SparkSession, source_dir: str, transfers_dir: str, prices_dir: str,
                       paths: ModelPaths, checkpoint: str, chain: str = "celo", floors: Floors = Floors(),
                       max_files_per_trigger: int | None = MAX_FILES, available_now: bool = True,
                       target_days: int | None = None) -> StreamingQuery:
    """Transactions, transfers and prices that arrive -> tx table upsert -> exact recompute of the touched days.

    One query over the three sources, so the tables have a single writer. Transfers and prices are
    read again from their folders for the touched days, with what has arrived by then; transfers in
    ``block_date=`` directories are pruned to those days. The day log lies beside the daily table.
    """
    tx = read_transactions_stream(spark, source_dir, max_files_per_trigger)
    tr = read_stream(spark, transfers_dir, schemas.TRANSFERS, max_files_per_trigger)
    pr = read_stream(spark, prices_dir, schemas.PRICES, max_files_per_trigger).where(F.col("blockchain") == chain)
    none = F.lit(None).cast(schemas.TRANSACTIONS)

    def arrival(df: DataFrame, source: str, row: Column, day: Column) -> DataFrame:
        return df.select(row.alias("tx"), day.cast("date").alias("day"), F.lit(source).alias("source"))

    arrivals = (arrival(tx, "transactions", F.struct(*[F.col(f"`{c}`") for c in tx.columns]), F.lit(None))
                .unionByName(arrival(tr, "transfers", none, F.col("block_date")))
                .unionByName(arrival(pr, "prices", none, F.to_date("timestamp"))))

    def write_batch(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        fresh = attribution.attribute_transactions(rows.where("tx is not null").select("tx.*"), floors, None)
        result = _upsert_batch(fresh, paths.transactions_attributed, True, target_days)
        # touched partitions = days of the batch plus days an updated key moved away from
        mine = session.createDataFrame([(d, "transactions") for d in result.touched_partitions], "day date, source string")
        found = log_days(session, day_log_path(paths), batch, rows.where("day is not null").select("day", "source").unionByName(mine))
        recompute_days(session, sorted({r.day for r in found}), session.read.schema(schemas.TRANSFERS).parquet(transfers_dir),
                       session.read.schema(schemas.PRICES).parquet(prices_dir), paths, chain, floors,
                       sorted({r.day for r in found if r.source != "prices"}))

    return _start(arrivals, write_batch, checkpoint, available_now)


def day_log_path(paths: ModelPaths) -> str:
    return f"{paths.daily_metric}_days"
