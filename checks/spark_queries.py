"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame whose columns and
values are engine-neutral (binary as lower-case hex text, decimals as text, day as date),
so they can be compared with the DuckDB oracle in ``checks.oracle``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import params as P
from codetrail import schemas as S
from codetrail.functions.keys import hex_text, portable, surrogate_key
from codetrail.functions.literals import typed_lit
from codetrail.functions.windows import tx_window
from codetrail.operators import attribution as A
from codetrail.operators import clustering as CL
from codetrail.operators import export as X
from codetrail.operators import metrics as M
from codetrail.operators import partials as PT
from codetrail.operators import quality as QL
from codetrail.operators import reports as R
from codetrail.operators import upsert as U
from codetrail.plans import models as MD
from codetrail.session import scratch_path
from checks import fixtures
from codetrail.sources.catalog import register_view
from codetrail.streaming import attribution_stream as ST


# -- sources -----------------------------------------------------------------

def tx_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load(spark, sf_dir, "transactions")


def transfer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load(spark, sf_dir, "transfers")


def price_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load(spark, sf_dir, "prices")


def ta_full(spark, sf_dir) -> DataFrame:
    return A.attribute_transactions(tx_source(spark, sf_dir), P.FLOORS)


def tra_full(spark, sf_dir, ta: DataFrame | None = None) -> DataFrame:
    ta = ta_full(spark, sf_dir) if ta is None else ta
    return A.attribute_transfers(A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS),
                                 A.attribution_keys(ta, P.FLOORS))


_MODEL_TABLES: dict[tuple[str, str], MD.ModelPaths] = {}


def model_tables(spark, sf_dir) -> MD.ModelPaths:
    """The first two models as written tables, built once for each session and data folder; the daily
    metric reads them, so calldata is decoded once, by the model that owns it."""
    memo = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if memo not in _MODEL_TABLES:
        paths = MD.ModelPaths.under(scratch_path(spark, "models"))
        MD.run_transactions(spark, tx_source(spark, sf_dir), paths.transactions_attributed, None, P.FLOORS)
        MD.run_transfers(spark, transfer_source(spark, sf_dir), paths.transactions_attributed, paths.transfers_attributed,
                         None, P.CHAIN, P.FLOORS)
        _MODEL_TABLES[memo] = paths
    return _MODEL_TABLES[memo]


def _daily(spark, sf_dir) -> DataFrame:
    paths = model_tables(spark, sf_dir)
    return M.daily_metrics(read_transfer_table(spark, paths.transfers_attributed), read_tx_table(spark, paths.transactions_attributed),
                           price_source(spark, sf_dir), P.CHAIN, P.FLOORS)


def _as_date(col: str = "day") -> F.Column:
    return F.to_date(F.col(col)).alias(col)


# -- model 1 -----------------------------------------------------------------

def q_tx_select(spark, sf_dir):
    return portable(A.select_transactions(tx_source(spark, sf_dir), P.FLOORS))


def q_trailer_fields(spark, sf_dir):
    df = A.parse_trailer(A.select_transactions(tx_source(spark, sf_dir), P.FLOORS))
    return portable(df.select("hash", "calldata_len", "tail_marker", "schema_id", "code_len"))


def q_trailer_decode(spark, sf_dir):
    df = A.extract_code(A.parse_trailer(A.select_transactions(tx_source(spark, sf_dir), P.FLOORS)))
    return portable(df.select("hash", "code_len", "multi_code"))


def q_tx_attributed(spark, sf_dir):
    return portable(ta_full(spark, sf_dir))


def q_flag_counts(spark, sf_dir):
    return R.flag_counts(ta_full(spark, sf_dir))


def q_model_counts(spark, sf_dir):
    ta = ta_full(spark, sf_dir)
    return R.labelled_counts({"transactions_attributed": ta, "transfers_attributed": tra_full(spark, sf_dir, ta)})


# -- model 2 -----------------------------------------------------------------

def q_transfers_select(spark, sf_dir):
    return portable(A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS))


def q_transfers_attributed(spark, sf_dir):
    return portable(tra_full(spark, sf_dir))


# -- model 3 -----------------------------------------------------------------

def q_effective_code(spark, sf_dir):
    at = M.attributed_transfers(tra_full(spark, sf_dir), P.FLOORS)
    return at.select(_as_date(), hex_text("tx_hash").alias("tx_hash"), "builder_code", "amount_usd")


def q_transfer_metrics(spark, sf_dir):
    tm = M.transfer_metrics(M.attributed_transfers(tra_full(spark, sf_dir), P.FLOORS))
    return tm.select(_as_date(), "builder_code", F.round("volume_usd", P.ROUND_USD).alias("volume_usd"),
                     "token_transfers_tx")


def q_tx_metrics(spark, sf_dir):
    txm = M.tx_metrics(M.attributed_txs(ta_full(spark, sf_dir), P.FLOORS))
    return txm.select(_as_date(), "builder_code", "tx_count", "unique_addresses")


def _fees(spark, sf_dir):
    return M.tx_fees(M.attributed_txs(ta_full(spark, sf_dir), P.FLOORS))


def q_tx_fees(spark, sf_dir):
    f = _fees(spark, sf_dir)
    return f.select(_as_date(), "builder_code", hex_text("tx_hash").alias("tx_hash"), "fee_token_amount",
                    hex_text("price_address").alias("price_address"))


def q_price_semi_join(spark, sf_dir):
    df = M.used_prices(price_source(spark, sf_dir), _fees(spark, sf_dir), P.CHAIN, P.FLOORS)
    return portable(df.select("blockchain", "timestamp", "contract_address", "price"))


def q_token_prices(spark, sf_dir):
    tp = M.token_prices(price_source(spark, sf_dir), _fees(spark, sf_dir), P.CHAIN, P.FLOORS)
    return tp.select(_as_date(), hex_text("contract_address").alias("contract_address"), "price")


def q_fee_metrics(spark, sf_dir):
    totals = M.fee_totals(_fees(spark, sf_dir))
    fm = M.fee_metrics(totals, M.token_prices(price_source(spark, sf_dir), totals, P.CHAIN, P.FLOORS))
    return fm.select(_as_date(), "builder_code", F.round("chain_fees_usd", P.ROUND_FEE).alias("chain_fees_usd"))


def daily_output(df: DataFrame) -> DataFrame:
    return df.select(
        _as_date(), "builder_code",
        F.round("volume_usd", P.ROUND_USD).alias("volume_usd"),
        "tx_count", "token_transfers_tx", "unique_addresses",
        F.round("chain_fees_usd", P.ROUND_FEE).alias("chain_fees_usd"),
    )


def q_daily_metrics(spark, sf_dir):
    return daily_output(_daily(spark, sf_dir))


# -- incremental windows and materializations ----------------------------------


def cut(df: DataFrame, as_of, col: str = "block_time") -> DataFrame:
    """What had arrived by ``as_of``: source rows up to that instant (None: all)."""
    return df if as_of is None else df.where(F.col(col) <= typed_lit(as_of))


def read_tx_table(spark, path) -> DataFrame:
    return spark.read.schema(S.TX_ATTRIBUTED).parquet(path).select(
        *[F.col(f"`{c}`") for c in S.TX_ATTRIBUTED_COLUMNS])


def read_transfer_table(spark, path) -> DataFrame:
    return spark.read.schema(S.TRANSFERS_ATTRIBUTED).parquet(path).select(
        *[F.col(f"`{c}`") for c in S.TRANSFERS_ATTRIBUTED_COLUMNS])


def q_incremental_window(spark, sf_dir):
    tx = cut(tx_source(spark, sf_dir), P.AS_OF_NEXT)
    return portable(A.attribute_transactions(tx, P.FLOORS, tx_window(P.AS_OF_NEXT)))


def q_upsert_delete_insert(spark, sf_dir):
    target = scratch_path(spark, "upsert-delete-insert") + "/transactions_attributed"
    tx = tx_source(spark, sf_dir)
    MD.run_transactions(spark, cut(tx, P.AS_OF_FIRST), target, None, P.FLOORS)         # first run
    MD.run_transactions(spark, cut(tx, P.AS_OF_NEXT), target, P.AS_OF_NEXT, P.FLOORS)  # incremental run
    MD.run_transactions(spark, tx, target, P.AS_OF_NEXT, P.FLOORS)                     # catch-up: all that came since
    return portable(read_tx_table(spark, target))


def q_upsert_target_days(spark, sf_dir):
    """Like ``upsert_delete_insert``, looking for old rows in the last two days only."""
    target = scratch_path(spark, "upsert-target-days") + "/transactions_attributed"
    tx = tx_source(spark, sf_dir)
    MD.run_transactions(spark, cut(tx, P.AS_OF_FIRST), target, None, P.FLOORS)
    MD.run_transactions(spark, cut(tx, P.AS_OF_NEXT), target, P.AS_OF_NEXT, P.FLOORS, target_days=2)
    MD.run_transactions(spark, tx, target, P.AS_OF_NEXT, P.FLOORS, date_in_key=True)
    return portable(read_tx_table(spark, target))


def q_upsert_changed_rows(spark, sf_dir):
    """New values win, rows move to another date, and the date that they leave is emptied."""
    target = scratch_path(spark, "upsert-changed") + "/transactions_attributed"
    ta = ta_full(spark, sf_dir)
    U.full_refresh(spark, ta, target, S.TX_PARTITION)
    day = F.col("block_date")
    moved = ta.where(day == typed_lit(P.MOVED_DAY)).withColumns({
        "block_time": F.col("block_time") + F.expr("INTERVAL 1 DAY"), "block_date": F.date_add("block_date", 1)})
    restated_rows = ta.where(day == typed_lit(P.RESTATED_DAY)).withColumn("gas_used", F.col("gas_used") * 2)
    result = U.delete_insert(spark, moved.unionByName(restated_rows), target, S.TX_KEY, S.TX_PARTITION)
    assert result.emptied_partitions == [P.MOVED_DAY]
    return portable(read_tx_table(spark, target))


def q_upsert_merge(spark, sf_dir):
    paths = MD.ModelPaths.under(scratch_path(spark, "upsert-merge"))
    tx, tr = tx_source(spark, sf_dir), transfer_source(spark, sf_dir)
    for as_of, win in ((P.AS_OF_FIRST, None), (P.AS_OF_NEXT, P.AS_OF_NEXT), (None, P.AS_OF_NEXT)):
        MD.run_transactions(spark, cut(tx, as_of), paths.transactions_attributed, win, P.FLOORS)
        MD.run_transfers(spark, cut(tr, as_of), paths.transactions_attributed, paths.transfers_attributed, win,
                         P.CHAIN, P.FLOORS, strategy="merge")
    return portable(read_transfer_table(spark, paths.transfers_attributed))


def restated(df: DataFrame) -> DataFrame:
    """A later version of the same transfers: updated an hour later with a corrected amount."""
    return df.withColumns({
        "_updated_at": F.col("_updated_at") + F.expr("INTERVAL 1 HOUR"),
        "amount_usd": F.col("amount_usd") * 2,
    })


def q_append_dedup(spark, sf_dir):
    target = scratch_path(spark, "append-dedup") + "/transfers"
    tr = transfer_source(spark, sf_dir)
    U.append(spark, A.select_transfers(cut(tr, P.AS_OF_FIRST), P.CHAIN, P.FLOORS), target, S.TRANSFER_KEY,
             S.TRANSFER_PARTITION)
    for until in (P.AS_OF_NEXT, None):
        batch = A.select_transfers(cut(tr, until), P.CHAIN, P.FLOORS, tx_window(P.AS_OF_NEXT))
        U.append(spark, batch.unionByName(restated(batch)), target, S.TRANSFER_KEY, S.TRANSFER_PARTITION,
                 dedupe_order_by="_updated_at", skip_existing=True)
    return portable(spark.read.parquet(target).select(*[F.col(f"`{c}`") for c in S.TRANSFER_PASSTHROUGH]))


def q_append_once(spark, sf_dir):
    """K5 exactly once: three batches, one of them delivered again; the ledger skips it."""
    target = scratch_path(spark, "append-once") + "/transfers"
    rows = A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS)
    for i in (0, 1, 1, 2):
        U.append_once(spark, rows.where(F.dayofmonth("block_date") % 3 == i), target, f"batch-{i}", S.TRANSFER_PARTITION)
    return portable(U.read_appended(spark, target, rows.schema))


def q_upsert_target_predicate(spark, sf_dir):
    """Old rows before the predicate's instant are not looked at: later runs put theirs beside them."""
    target = scratch_path(spark, "upsert-predicate") + "/transactions_attributed"
    tx = tx_source(spark, sf_dir)
    bound = F.col("block_time") >= typed_lit(P.AS_OF_FIRST)
    MD.run_transactions(spark, cut(tx, P.AS_OF_FIRST), target, None, P.FLOORS)
    for until in (P.AS_OF_NEXT, None):
        MD.run_transactions(spark, cut(tx, until), target, P.AS_OF_NEXT, P.FLOORS, target_predicate=bound)
    return portable(read_tx_table(spark, target))


def q_daily_recompute(spark, sf_dir):
    paths = MD.ModelPaths.under(scratch_path(spark, "daily-recompute"))
    tx, tr, pr = tx_source(spark, sf_dir), transfer_source(spark, sf_dir), price_source(spark, sf_dir)
    # the last run catches up: its window starts at the last run that saw everything
    for until, win in ((P.AS_OF_FIRST, None), (P.AS_OF_METRIC, P.AS_OF_METRIC), (None, P.AS_OF_FIRST)):
        MD.run_all(spark, cut(tx, until), cut(tr, until), cut(pr, until, "timestamp"), paths, win, P.CHAIN, P.FLOORS)
    return daily_output(spark.read.schema(S.DAILY_METRIC).parquet(paths.daily_metric))


def q_daily_replace_days(spark, sf_dir):
    """Whole days of the window are replaced: a day emptied upstream leaves the daily metric too."""
    paths = MD.ModelPaths.under(scratch_path(spark, "daily-replace"))
    tx, tr, pr = tx_source(spark, sf_dir), transfer_source(spark, sf_dir), price_source(spark, sf_dir)
    MD.run_all(spark, tx, tr, pr, paths, None, P.CHAIN, P.FLOORS)
    gone = F.col("block_date") == typed_lit(P.EMPTIED_DAY)
    MD.run_transactions(spark, tx.where(~gone), paths.transactions_attributed, None, P.FLOORS, full_refresh=True)
    MD.run_daily(spark, pr, paths.transactions_attributed, paths.transfers_attributed, paths.daily_metric, P.AS_OF_METRIC,
                 P.CHAIN, P.FLOORS, replace_days=True)
    return daily_output(spark.read.schema(S.DAILY_METRIC).parquet(paths.daily_metric))


# -- joins, unions, keys, reports ------------------------------------------------

JOIN_START, JOIN_END = _dt.date(2024, 1, 10), _dt.date(2024, 1, 12)


def q_hash_date_inner_join(spark, sf_dir):
    tr = A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS)
    j = R.transfers_with_tx(tr, ta_full(spark, sf_dir), JOIN_START, JOIN_END)
    return j.select(F.col("t.unique_key"), hex_text(F.col("t.tx_hash")).alias("tx_hash"), F.col("t.block_date"),
                    F.col("a.has_builder_code"), F.col("a.builder_code"), F.col("t.amount_usd"))


def q_union_tagged(spark, sf_dir):
    tr = transfer_source(spark, sf_dir)
    cols = ["unique_key", "block_date", "amount_usd"]
    named = {c: A.select_transfers(tr, c, P.FLOORS).select(*cols) for c in ("celo", "other")}
    return R.union_tagged(named, "chain_tag")


def q_surrogate_key(spark, sf_dir):
    tra = tra_full(spark, sf_dir)
    return tra.select("unique_key", surrogate_key(hex_text("tx_hash"), "evt_index", "builder_code2").alias("sk"))


def q_top_codes(spark, sf_dir):
    top = R.top_k(R.code_totals(_daily(spark, sf_dir)), P.TOP_K, "volume_usd", ["builder_code"])
    return top.select("builder_code", F.round("volume_usd", P.ROUND_USD).alias("volume_usd"), "tx_count",
                      F.round("chain_fees_usd", P.ROUND_FEE).alias("chain_fees_usd"))


# -- data quality -------------------------------------------------------------------

def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_dq_not_null(spark, sf_dir):
    paths = model_tables(spark, sf_dir)
    ta = read_tx_table(spark, paths.transactions_attributed)
    tra = read_transfer_table(spark, paths.transfers_attributed)
    dm = _daily(spark, sf_dir)
    src = A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS)
    return (QL.TRANSACTIONS_RULES.run(ta).where(F.col("rule") == "not_null")
            .unionByName(QL.TRANSFERS_RULES.run(tra).where(F.col("rule") == "not_null"))
            .unionByName(QL.not_null_summary(dm, QL.DAILY_RULES.not_null, QL.DAILY_RULES.model))
            .unionByName(QL.not_null_summary(src, ["amount_usd"], "transfers")))


def q_dq_unique(spark, sf_dir):
    ta = ta_full(spark, sf_dir)
    parts = [
        QL.count_summary(QL.unique_failures(_table(spark, sf_dir, "events"), "event_id"), "events", "unique", "event_id"),
        QL.count_summary(QL.unique_failures(_table(spark, sf_dir, "orders"), "o_custkey"), "orders", "unique",
                         "o_custkey"),
        QL.count_summary(QL.unique_failures(ta, "hash"), "transactions_attributed", "unique", "hash"),
        QL.count_summary(QL.unique_failures(tra_full(spark, sf_dir, ta), "unique_key"), "transfers_attributed",
                         "unique", "unique_key"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dq_unique_combination(spark, sf_dir):
    rule = "unique_combination_of_columns"
    parts = [
        QL.count_summary(QL.unique_combination_failures(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
                         "lineitem", rule, "l_orderkey,l_linenumber"),
        QL.count_summary(QL.unique_combination_failures(transfer_source(spark, sf_dir), ["tx_hash", "evt_index"]), "transfers",
                         rule, "tx_hash,evt_index"),
        QL.count_summary(QL.unique_combination_failures(_daily(spark, sf_dir), ["day", "builder_code"]),
                         "buildercode_daily_metric", rule, "day,builder_code"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ORDER_STATUS = ["F", "O", "P"]


def q_dq_accepted_values(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    a = QL.count_summary(QL.accepted_values_failures(orders, "o_orderstatus", ORDER_STATUS), "orders",
                         "accepted_values", "o_orderstatus:F,O,P")
    b = QL.count_summary(QL.accepted_values_failures(orders, "o_orderstatus", ORDER_STATUS[:2]), "orders",
                         "accepted_values", "o_orderstatus:F,O")
    c = QL.count_summary(QL.accepted_values_failures(tra_full(spark, sf_dir), "blockchain", [P.CHAIN]),
                         "transfers_attributed", "accepted_values", "blockchain:celo")
    return a.unionByName(b).unionByName(c)


def q_dq_relationships(spark, sf_dir):
    a = QL.count_summary(QL.relationships_failures(_table(spark, sf_dir, "nation"), "n_regionkey",
                                                   _table(spark, sf_dir, "region"), "r_regionkey"),
                         "nation", "relationships", "n_regionkey->region.r_regionkey")
    tr = A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS)
    b = QL.count_summary(QL.relationships_failures(tr, "tx_hash", ta_full(spark, sf_dir), "hash"),
                         "transfers", "relationships", "tx_hash->transactions_attributed.hash")
    return a.unionByName(b)


def q_dq_invariants(spark, sf_dir):
    paths = model_tables(spark, sf_dir)
    ta = read_tx_table(spark, paths.transactions_attributed)
    tra = read_transfer_table(spark, paths.transfers_attributed)
    dm = _daily(spark, sf_dir)
    custom = QL.ModelRules("buildercode_daily_metric", custom={
        "non_negative_fees": lambda d: d.where(F.col("chain_fees_usd") < 0)})
    return (QL.count_summary(QL.tx_invariant_failures(ta), "transactions_attributed", "invariant", "flag_codes")
            .unionByName(QL.count_summary(QL.transfer_invariant_failures(tra, P.CHAIN), "transfers_attributed",
                                          "invariant", "flag_codes_chain"))
            .unionByName(QL.count_summary(QL.daily_invariant_failures(dm), "buildercode_daily_metric", "invariant",
                                          "counts_bounded"))
            .unionByName(custom.run(dm)))


# -- export ---------------------------------------------------------------------------

EXPORT_META = {"export": {
    "enabled": True,
    "time_column": "block_time",
    "time_start": P.EXPORT_START,
    "time_start_incremental": lambda as_of: as_of - _dt.timedelta(days=1),
}}
DAILY_EXPORT = {"export": {"enabled": True, "time_column": "day", "time_start": None, "time_start_incremental": None}}
EXPORT_SECOND_RUN = P.EXPORT_END + _dt.timedelta(days=2)
EXPORT_THIRD_RUN = P.EXPORT_END + _dt.timedelta(days=3)


def _export(spark, sf_dir):
    """A first export, an incremental one with a table model beside it, then a manual re-sync of the
    same window from which rows have vanished upstream (the destination keeps them)."""
    root = scratch_path(spark, "export")
    ta = ta_full(spark, sf_dir)
    src, daily, dest = f"{root}/transactions_attributed", f"{root}/daily", f"{root}/export"
    U.full_refresh(spark, ta, src, S.TX_PARTITION)
    U.full_refresh(spark, _daily(spark, sf_dir), daily)
    tx = X.ExportedModel("transactions_attributed", src, S.TX_KEY, EXPORT_META, partition_by=S.TX_PARTITION)
    table = X.ExportedModel("buildercode_daily_metric", daily, S.DAILY_KEY, DAILY_EXPORT, "table")
    X.sync_models(spark, [tx], dest, P.EXPORT_END, is_incremental=False)
    X.sync_models(spark, [tx, table], dest, EXPORT_SECOND_RUN, is_incremental=True)
    start = EXPORT_SECOND_RUN - _dt.timedelta(days=1)
    t = F.col("block_time")
    kept = ta.where(~((t >= typed_lit(start)) & (t < typed_lit(start + _dt.timedelta(hours=6)))))
    U.full_refresh(spark, kept, src, S.TX_PARTITION)
    X.sync_models(spark, [tx], dest, EXPORT_THIRD_RUN, is_incremental=True, time_start=start, time_end=EXPORT_SECOND_RUN)
    return f"{dest}/transactions_attributed", f"{dest}/_runs"


def q_export_window(spark, sf_dir):
    dest, _ = _export(spark, sf_dir)
    return portable(spark.read.parquet(dest).select("hash", "block_time", "block_date", "has_builder_code",
                                                    "builder_code"))


CHANGES_FIRST, CHANGES_NEXT = P.EXPORT_END, P.EXPORT_END + _dt.timedelta(days=1)


def q_export_changes(spark, sf_dir):
    """K10 by content: a restated day is sent again, rows of an emptied day are deleted, the others are left alone."""
    dest, day = scratch_path(spark, "export-changes") + "/transactions_attributed", F.col("block_date")
    ta = ta_full(spark, sf_dir)
    X.export_changes(spark, ta, dest, S.TX_KEY, S.TX_PARTITION, CHANGES_FIRST)
    now = ta.where(day != typed_lit(P.EMPTIED_DAY)).withColumn("gas_used", F.when(day == typed_lit(P.RESTATED_DAY), F.col("gas_used") * 2).otherwise(F.col("gas_used")))
    changes = X.export_changes(spark, now, dest, S.TX_KEY, S.TX_PARTITION, CHANGES_NEXT)
    sent = spark.read.schema(S.TX_ATTRIBUTED).parquet(dest).select("hash", F.col("block_date").alias("day"), "gas_used")
    both = sent.join(changes.select("hash", "op", F.col("block_date").alias("change_day")), "hash", "full")
    return both.select(hex_text("hash").alias("hash"), F.coalesce("day", "change_day").alias("block_date"), "gas_used", "op")


def _log_out(df):
    return portable(df.select("source_table", "time_column",
                              F.concat_ws(",", "unique_key_columns").alias("unique_key_columns"),
                              "time_start", "time_end", "full_refresh", "rows_synced", "created_at"))


def q_export_runs(spark, sf_dir):
    _, log = _export(spark, sf_dir)
    return _log_out(X.runs(spark, log))


def q_export_log_latest(spark, sf_dir):
    _, log = _export(spark, sf_dir)
    return _log_out(X.latest_runs(spark, log, 1, "transactions_attributed"))


# -- streaming ---------------------------------------------------------------------------


STREAM_FILES_PER_TRIGGER = 10


def _tx_dir(spark, sf_dir):
    return fixtures.materialize(spark, sf_dir)["transactions"]


def q_stream_attributed(spark, sf_dir):
    root = scratch_path(spark, "stream-attributed")
    q = ST.start_transactions_stream(spark, _tx_dir(spark, sf_dir), f"{root}/transactions_attributed",
                                     f"{root}/_checkpoint", P.FLOORS,
                                     max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return portable(read_tx_table(spark, f"{root}/transactions_attributed"))


def _deliver(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Rows that arrive after the ones before them, in Spark's own files."""
    w = df.write.mode("append")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def q_stream_dedup(spark, sf_dir):
    """The newest days first, then older ones, then everything once more: nothing is too late."""
    root = scratch_path(spark, "stream-dedup")
    src = f"{root}/source"
    tx, day = tx_source(spark, sf_dir), F.dayofmonth("block_date")
    for part in (tx.where(day > 20), tx.where((day > 10) & (day <= 20)), tx.where(day <= 10), tx.unionByName(tx.where(day == 7))):
        _deliver(part, src)
        ST.start_transactions_stream(spark, src, f"{root}/transactions_attributed", f"{root}/_checkpoint",
                                     P.FLOORS, dedup=True).awaitTermination()
    return portable(read_tx_table(spark, f"{root}/transactions_attributed"))


def q_stream_dedup_state(spark, sf_dir):
    """T6 with state: newer days, then days older than the watermark and some again, then everything once more."""
    root = scratch_path(spark, "stream-dedup-state")
    src, target, late = f"{root}/source", f"{root}/transactions_attributed", f"{root}/late"
    tx, day = tx_source(spark, sf_dir), F.dayofmonth("block_date")
    for part in (tx.where(day > 10), tx.where((day <= 10) | (day == 20)), tx):
        _deliver(part, src)
        ST.run_dedup_streams(spark, src, target, late, f"{root}/_checkpoint", P.FLOORS)
    return portable(ST.read_with_late(spark, target, late))


def q_daily_partials(spark, sf_dir):
    """A2/A3/T3 by merging partials: six-hourly arrivals, transfers before their transactions, a batch sent twice."""
    root = scratch_path(spark, "partials")
    tx, tr, quarter = tx_source(spark, sf_dir), transfer_source(spark, sf_dir), F.floor(F.hour("block_time") / 6)
    for k in (3, 0, 1, 2):
        PT.add_transfers(spark, tr.where(quarter == k), root, f"q{k}", P.CHAIN, P.FLOORS)
    for k in (0, 1, 2, 3, 3):
        PT.add_transactions(spark, tx.where(quarter == k), root, f"q{k}", P.FLOORS)
    return daily_output(PT.daily_from_parts(spark, root, price_source(spark, sf_dir), None, P.CHAIN, P.FLOORS))


def q_stream_daily(spark, sf_dir):
    """Transfers of some days, then prices of others, arrive after their days' micro-batch and touch them again."""
    root = scratch_path(spark, "stream-daily")
    paths = MD.ModelPaths.under(root)
    tr, pr = transfer_source(spark, sf_dir), price_source(spark, sf_dir)
    day, price_day = F.dayofmonth("block_date"), F.dayofmonth("timestamp")
    late, prices, ckpt = f"{root}/transfers", f"{root}/prices", f"{root}/_checkpoint"

    def arrive(transfers, price_rows):
        if transfers is not None:
            _deliver(transfers, late, S.TRANSFER_PARTITION)
        _deliver(price_rows, prices)
        ST.start_daily_stream(spark, _tx_dir(spark, sf_dir), late, prices, paths, ckpt, P.CHAIN, P.FLOORS).awaitTermination()

    arrive(tr.where(day % 3 != 0), pr.where(price_day % 4 == 0))
    arrive(tr.where(day % 3 == 0), pr.where(price_day % 4 == 1))
    arrive(None, pr.where(price_day % 4 > 1))
    return daily_output(spark.read.schema(S.DAILY_METRIC).parquet(paths.daily_metric))


# -- more materializations and joins ------------------------------------------------------


def q_view_spot_check(spark, sf_dir):
    """K1 + SQL: models registered as views, spot-checked with SQL."""
    ta = ta_full(spark, sf_dir)
    register_view(ta, "transactions_attributed")
    register_view(tra_full(spark, sf_dir, ta), "transfers_attributed")
    return spark.sql("""
        SELECT 'transactions' AS model, has_builder_code, COUNT(*) AS n
        FROM transactions_attributed GROUP BY has_builder_code
        UNION ALL
        SELECT 'transfers' AS model, has_builder_code, COUNT(*) AS n
        FROM transfers_attributed GROUP BY has_builder_code
    """)


def q_upsert_key_lookup(spark, sf_dir):
    """K3 with key lookups: wrong fees of one transaction in fifty are mended by batches of few keys."""
    target = scratch_path(spark, "key-lookup") + "/transactions_attributed"
    ta = ta_full(spark, sf_dir)
    part = F.pmod(F.col("block_number"), F.lit(500))
    wrong = ta.withColumn("gas_used", F.when(part < 10, F.col("gas_used") + 1).otherwise(F.col("gas_used")).cast("long"))
    for batch in (wrong, ta.where(part < 5), ta.where((part >= 5) & (part < 10))):
        U.delete_insert(spark, batch, target, S.TX_KEY, S.TX_PARTITION, lookup_limit=10_000)
    return portable(read_tx_table(spark, target))


def q_full_refresh(spark, sf_dir):
    """K6: after runs over restated rows, a full refresh rebuilds the table from the floors."""
    target = scratch_path(spark, "full-refresh") + "/transactions_attributed"
    tx = tx_source(spark, sf_dir)
    wrong = tx.withColumn("gas_used", F.col("gas_used") + 1)
    MD.run_transactions(spark, cut(wrong, P.AS_OF_FIRST), target, None, P.FLOORS)
    MD.run_transactions(spark, cut(wrong, P.AS_OF_NEXT), target, P.AS_OF_NEXT, P.FLOORS)
    MD.run_transactions(spark, tx, target, None, P.FLOORS, full_refresh=True)
    return portable(read_tx_table(spark, target))


def q_full_refresh_switch(spark, sf_dir):
    """K2/K6 by switching a catalog name: a wrong version, then the right one; no folder is renamed."""
    root, name = scratch_path(spark, "switch"), "transactions_attributed_current"
    ta = ta_full(spark, sf_dir)
    U.refresh_switch(spark, ta.withColumn("gas_used", F.col("gas_used") + 1), name, root, S.TX_PARTITION)
    U.refresh_switch(spark, ta, name, root, S.TX_PARTITION)
    return portable(spark.table(name).select(*[F.col(f"`{c}`") for c in S.TX_ATTRIBUTED_COLUMNS]))


CLUSTER_DAY, DQ_FROM = _dt.date(2024, 1, 12), _dt.date(2024, 1, 20)


def q_compaction(spark, sf_dir):
    """K9: a table written in many small increments, compacted: same rows, one file a day, and settled."""
    target = scratch_path(spark, "compaction") + "/transactions_attributed"
    ta = ta_full(spark, sf_dir)
    for part in range(4):  # four appends of disjoint slices -> several files per partition
        U.write_table(ta.where(F.pmod(F.hash("hash"), F.lit(4)) == part), target, S.TX_PARTITION, mode="append")
    assert U.compact(spark, target, S.TX_PARTITION, max_files=1)
    files = U.file_counts(spark, target, S.TX_PARTITION).select(
        F.to_date(F.regexp_extract("directory", "=(.*)$", 1)).alias("block_date"), (F.col("files") == 1).alias("one_file"))
    settled = not U.compact(spark, target, S.TX_PARTITION, max_files=1)
    rows = read_tx_table(spark, target).groupBy("block_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("block_number").alias("numbers"), F.count_distinct("hash").alias("hashes"))
    return rows.join(files, "block_date").withColumn("settled", F.lit(settled))


def q_compaction_clustered(spark, sf_dir):
    """K9 along a space-filling curve of (block_time, hash): same rows, settled, and only a changed day is due again."""
    target = scratch_path(spark, "clustered") + "/transactions_attributed"
    ta = ta_full(spark, sf_dir)
    for part in range(2):
        U.write_table(ta.where(F.pmod(F.hash("hash"), F.lit(2)) == part), target, S.TX_PARTITION, mode="append")
    first = CL.cluster(spark, target, S.TX_PARTITION, ["block_time", "hash"])
    settled = not CL.cluster(spark, target, S.TX_PARTITION, ["block_time", "hash"])
    U.replace_partitions(spark, ta.where(F.col("block_date") == typed_lit(CLUSTER_DAY)), target, S.TX_PARTITION, [CLUSTER_DAY])
    again = [x for x in CL.cluster(spark, target, S.TX_PARTITION, ["block_time", "hash"])]
    days = spark.createDataFrame([(x.split("=")[1],) for x in first], "d string").select(F.to_date("d").alias("block_date"))
    rows = read_tx_table(spark, target).groupBy("block_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("block_number").alias("numbers"), F.count_distinct("hash").alias("hashes"))
    return rows.join(days.withColumn("clustered", F.lit(True)), "block_date", "left").select(
        "*", F.lit(settled).alias("settled"), F.col("block_date").cast("string").isin([x.split("=")[1] for x in again]).alias("due_again"))


def q_dq_written(spark, sf_dir):
    """Q1-Q3 inside the write: a batch with NULL senders and repeated keys is upserted; the rules count what the write
    saw and look at the keys of the touched days only."""
    target = scratch_path(spark, "dq-written") + "/transactions_attributed"
    ta = ta_full(spark, sf_dir)
    U.write_table(ta, target, S.TX_PARTITION)
    late = ta.where(F.col("block_date") >= typed_lit(DQ_FROM))
    number = F.col("block_number")
    late = late.withColumn("from", F.when(number % 7 != 0, F.col("from"))).unionByName(late.where(number % 11 == 0))
    batch, seen = QL.observed(late, QL.TRANSACTIONS_RULES)
    done = U.delete_insert(spark, batch, target, S.TX_KEY, S.TX_PARTITION)
    scope = U.in_partitions([S.TX_PARTITION], [(v,) for v in done.touched_partitions])
    return QL.observed_summary(read_tx_table(spark, target), QL.TRANSACTIONS_RULES, seen, scope)


def q_spot_check(spark, sf_dir):
    """``select * limit n`` has no fixed rows; their number and columns are, and that they are the model's."""
    ta = ta_full(spark, sf_dir)
    some = R.spot_check(ta, P.SPOT_ROWS)
    found = some.select("hash").join(ta.select(F.col("hash").alias("h"), F.lit(True).alias("stored")), F.col("hash") == F.col("h"), "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.lit(len(some.columns)).cast("long").alias("columns"), F.bool_and("stored").alias("stored"))


def users(spark, sf_dir) -> DataFrame:
    """A user dimension derived from events: address, first activity and event count."""
    ev = fixtures.load_events(spark, sf_dir)
    return ev.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("n_events")).select(
        F.unhex(F.substring(F.sha2(F.concat(F.lit("user-"), F.col("user_id").cast("string")), 256), 1, 40))
        .alias("address"), "first_seen", "n_events")


def q_address_left_join(spark, sf_dir):
    """Transactions LEFT JOIN a user dimension ON from = address."""
    t = ta_full(spark, sf_dir).select("hash", "from", "block_time", "builder_code").alias("t")
    u = users(spark, sf_dir).alias("u")
    j = t.join(u, F.col("t.from") == F.col("u.address"), "left")
    return portable(j.select(F.col("t.hash"), F.col("t.from"), F.col("t.block_time"), F.col("t.builder_code"),
                             F.col("u.first_seen"), F.col("u.n_events")))


def q_transfers_attributed_tagged(spark, sf_dir):
    """J1 with the right side pruned to tagged transactions (same result when hash is unique)."""
    ta = ta_full(spark, sf_dir)
    keys = A.attribution_keys(ta, P.FLOORS, tagged_only=True)
    tr = A.select_transfers(transfer_source(spark, sf_dir), P.CHAIN, P.FLOORS)
    return portable(A.attribute_transfers(tr, keys))


def bucketed_models(spark, sf_dir, buckets: int = 16) -> tuple[str, str]:
    """Transfers and attributed transactions as bucketed catalog tables; their names."""
    root = scratch_path(spark, "bucketed")
    tag = root.rsplit("-", 1)[1]
    names = f"transfers_{tag}", f"transactions_{tag}"
    U.write_bucketed(transfer_source(spark, sf_dir), names[0], f"{root}/transfers", "tx_hash", buckets)
    U.write_bucketed(ta_full(spark, sf_dir), names[1], f"{root}/transactions", "hash", buckets)
    return names


def attributed_from_buckets(spark, transfers: str, transactions: str) -> DataFrame:
    return A.attribute_transfers(A.select_transfers(spark.table(transfers), P.CHAIN, P.FLOORS), A.attribution_keys(spark.table(transactions), P.FLOORS))


def q_transfers_attributed_bucketed(spark, sf_dir):
    """J1 between two bucketed tables: no shuffle under the join."""
    return portable(attributed_from_buckets(spark, *bucketed_models(spark, sf_dir)))


RESTART_SPLIT = _dt.date(2024, 1, 15)
REDELIVERY_FROM = _dt.date(2024, 1, 10)


def q_stream_restart(spark, sf_dir):
    """T5 across a restart: files arrive after the query stopped (some days delivered twice);
    the restarted query resumes from its checkpoint and the keyed upsert absorbs re-deliveries."""
    root = scratch_path(spark, "stream-restart")
    src, target, ckpt = f"{root}/source", f"{root}/transactions_attributed", f"{root}/_checkpoint"
    tx = tx_source(spark, sf_dir)
    tx.where(F.col("block_date") < typed_lit(RESTART_SPLIT)).write.mode("append").parquet(src)
    ST.start_transactions_stream(spark, src, target, ckpt, P.FLOORS).awaitTermination()
    tx.where(F.col("block_date") >= typed_lit(REDELIVERY_FROM)).write.mode("append").parquet(src)
    ST.start_transactions_stream(spark, src, target, ckpt, P.FLOORS).awaitTermination()
    return portable(read_tx_table(spark, target))
