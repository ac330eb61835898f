"""Run the three models the way a scheduler would: first run / full refresh, then
incremental runs with look-back windows and keyed delete+insert.

``is_incremental`` = the target exists and no full refresh was asked; only then are the
windows applied. Upstream models are read back from their written tables, which also
cuts the lineage between models.
"""

from __future__ import annotations

import datetime as dt
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from codetrail import schemas
from codetrail.functions.windows import Floors, metric_window, target_bound, tx_window
from codetrail.operators import attribution, metrics, quality, upsert
from codetrail.sources.catalog import read_table
from codetrail.session import ensure_conf, join_as_dealt, path_exists


@dataclass(frozen=True)
class ModelPaths:
    transactions_attributed: str
    transfers_attributed: str
    daily_metric: str

    @classmethod
    def under(cls, root: str) -> "ModelPaths":
        root = root.rstrip("/")
        return cls(f"{root}/transactions_attributed", f"{root}/transfers_attributed",
                   f"{root}/buildercode_daily_metric")


def is_incremental(spark: SparkSession, target: str, full_refresh: bool) -> bool:
    return (not full_refresh) and path_exists(spark, target)


STRATEGIES = {"delete+insert": upsert.delete_insert, "merge": upsert.merge}


def _materialize(spark, df, target, key, partition_by, incremental, strategy="delete+insert",
                 rebalance=True, target_predicate: Column | None = None, rules: quality.ModelRules | None = None) -> upsert.UpsertResult:
    seen = None
    if rules is not None:
        df, seen = quality.observed(df, rules)
    if incremental:
        # rows of one date come out of many tasks once the anti join shuffles: always rebalance
        result = STRATEGIES[strategy](spark, df, target, key, partition_by, target_predicate=target_predicate)
    else:
        result = upsert.full_refresh(spark, df, target, partition_by, rebalance=rebalance)
    result.observed = seen
    return result


def _bound(as_of, target_days, target_predicate, date_col) -> Column | None:
    return target_predicate if target_predicate is not None else target_bound(as_of, target_days, date_col)


def _key(key: list[str], partition: str, date_in_key: bool) -> list[str]:
    return [*key, partition] if date_in_key and partition not in key else key


def run_transactions(spark: SparkSession, tx: DataFrame, target: str, as_of: dt.datetime | None = None,
                     floors: Floors = Floors(), full_refresh: bool = False, target_days: int | None = None,
                     target_predicate: Column | None = None, date_in_key: bool = False, observe: bool = False) -> upsert.UpsertResult:
    """An incremental run looks for old rows of its keys in the whole table (exact) unless it is bounded:
    ``target_days`` looks at the last days only (partition pruning), ``target_predicate`` at any
    part, ``date_in_key=True`` at the batch's own dates. An old row outside the bound is then not
    replaced, so a bound must cover how far back a key's date can move.
    ``observe=True`` counts rows and NULLs for the quality rules during the write."""
    ensure_conf(spark)
    inc = is_incremental(spark, target, full_refresh)
    df = attribution.attribute_transactions(tx, floors, tx_window(as_of) if inc else None)
    # First run: map-only over a source partitioned by the same date, every task already writes one
    # date, so no rebalance shuffle of the largest table (models 2 and 3 come out of shuffles; 2's deals by date).
    return _materialize(spark, df, target, _key(schemas.TX_KEY, schemas.TX_PARTITION, date_in_key), schemas.TX_PARTITION, inc,
                        rebalance=False, target_predicate=_bound(as_of, target_days, target_predicate, schemas.TX_PARTITION),
                        rules=quality.TRANSACTIONS_RULES if observe else None)


def run_transfers(spark: SparkSession, tr: DataFrame, tx_attributed_path: str, target: str,
                  as_of: dt.datetime | None = None, chain: str = "celo", floors: Floors = Floors(),
                  full_refresh: bool = False, tagged_only: bool = False, strategy: str = "delete+insert",
                  target_days: int | None = None, target_predicate: Column | None = None,
                  date_in_key: bool = False, observe: bool = False) -> upsert.UpsertResult:
    """Bounds and ``observe`` as in :func:`run_transactions`."""
    ensure_conf(spark)
    inc = is_incremental(spark, target, full_refresh)
    w = tx_window(as_of) if inc else None
    ta = read_table(spark, tx_attributed_path, schemas.TX_ATTRIBUTED)
    keys = attribution.attribution_keys(ta, floors, w, tagged_only=tagged_only)
    transfers = attribution.select_transfers(tr, chain, floors, w)
    # A first run writes what the join deals by day; an incremental one is rebalanced with the rows that stay.
    counts = None if inc else attribution.rows_by_day(transfers, upsert.MAX_PARTITIONS)
    df = attribution.attribute_transfers(transfers, keys) if counts is None else attribution.attribute_by_day(transfers, keys, counts)
    with nullcontext() if counts is None else join_as_dealt(spark):
        return _materialize(spark, df, target, _key(schemas.TRANSFER_KEY, schemas.TRANSFER_PARTITION, date_in_key),
                            schemas.TRANSFER_PARTITION, inc, strategy, rebalance=counts is None,
                            target_predicate=_bound(as_of, target_days, target_predicate, schemas.TRANSFER_PARTITION),
                            rules=quality.TRANSFERS_RULES if observe else None)


def run_daily(spark: SparkSession, prices: DataFrame, tx_attributed_path: str, transfers_attributed_path: str,
              target: str, as_of: dt.datetime | None = None, chain: str = "celo", floors: Floors = Floors(),
              full_refresh: bool = False, replace_days: bool = False) -> upsert.UpsertResult:
    """``replace_days=True`` replaces all days of the window, so a (day, code) or a whole day that
    vanished upstream is removed; the default keys on (day, builder_code) like the reference."""
    ensure_conf(spark)
    inc = is_incremental(spark, target, full_refresh)
    ta = read_table(spark, tx_attributed_path, schemas.TX_ATTRIBUTED)
    tra = read_table(spark, transfers_attributed_path, schemas.TRANSFERS_ATTRIBUTED)
    window = metric_window(as_of) if inc else None
    df = metrics.daily_metrics(tra, ta, prices, chain, floors, window)
    if window is not None and replace_days:
        return upsert.replace_where(spark, df, target, window.ts_pred("day"))
    # Small table (days x codes): unpartitioned, rewritten whole and swapped in.
    return _materialize(spark, df, target, schemas.DAILY_KEY, None, inc)


def run_all(spark: SparkSession, tx: DataFrame, tr: DataFrame, prices: DataFrame, paths: ModelPaths,
            as_of: dt.datetime | None = None, chain: str = "celo", floors: Floors = Floors(),
            full_refresh: bool = False, target_days: int | None = None, replace_days: bool = False) -> dict[str, upsert.UpsertResult]:
    """The DAG in dependency order: transactions -> transfers -> daily metric."""
    r1 = run_transactions(spark, tx, paths.transactions_attributed, as_of, floors, full_refresh, target_days)
    r2 = run_transfers(spark, tr, paths.transactions_attributed, paths.transfers_attributed, as_of, chain, floors,
                       full_refresh, target_days=target_days)
    r3 = run_daily(spark, prices, paths.transactions_attributed, paths.transfers_attributed, paths.daily_metric,
                   as_of, chain, floors, full_refresh, replace_days)
    return {"transactions_attributed": r1, "transfers_attributed": r2, "buildercode_daily_metric": r3}
