"""Late data (FIXTURES 3.5): one tagged transaction is held back and delivered later."""

import datetime as dt

from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail.plans import models as MD

from .conftest import SF_SMALL

LATE_EVENT = 550  # event_id % 11 == 0 -> carries a valid single code


def late_tx(spark):
    tx = Q.tx_source(spark, SF_SMALL)
    row = tx.where(F.col("block_number") == LATE_EVENT).select("block_time", "hash").first()
    return row["block_time"], row["hash"]


def run(spark, paths, as_of, incremental, hold_tx=False, hold_transfers=False):
    tx, tr, pr = Q.tx_source(spark, SF_SMALL), Q.transfer_source(spark, SF_SMALL), Q.price_source(spark, SF_SMALL)
    tx, tr, pr = Q.cut(tx, as_of), Q.cut(tr, as_of), Q.cut(pr, as_of, "timestamp")
    if hold_tx:
        tx = tx.where(F.col("block_number") != LATE_EVENT)
    if hold_transfers:
        tr = tr.where(F.col("block_number") != LATE_EVENT)
    MD.run_all(spark, tx, tr, pr, paths, as_of if incremental else None, P.CHAIN, P.FLOORS)


def tx_present(spark, paths, h):
    return spark.read.parquet(paths.transactions_attributed).where(F.col("hash") == F.lit(h)).count() == 1


def transfer_flags(spark, paths, h):
    df = spark.read.parquet(paths.transfers_attributed).where(F.col("tx_hash") == F.lit(h))
    return sorted(r["has_builder_code"] for r in df.collect())


def test_late_row_inside_window_is_repaired(spark, scratch):
    t, h = late_tx(spark)
    paths = MD.ModelPaths.under(scratch)
    run(spark, paths, t - dt.timedelta(days=1), False)
    run(spark, paths, t + dt.timedelta(hours=1), True, hold_tx=True, hold_transfers=True)
    assert not tx_present(spark, paths, h)
    run(spark, paths, t + dt.timedelta(hours=7), True)
    assert tx_present(spark, paths, h)


def test_late_row_outside_window_waits_for_full_refresh(spark, scratch):
    t, h = late_tx(spark)
    paths = MD.ModelPaths.under(scratch)
    run(spark, paths, t - dt.timedelta(days=1), False)
    run(spark, paths, t + dt.timedelta(hours=1), True, hold_tx=True)
    run(spark, paths, t + dt.timedelta(hours=49), True)
    assert not tx_present(spark, paths, h)
    MD.run_all(spark, *[Q.cut(s, t + dt.timedelta(hours=49), c) for s, c in (
        (Q.tx_source(spark, SF_SMALL), "block_time"), (Q.transfer_source(spark, SF_SMALL), "block_time"),
        (Q.price_source(spark, SF_SMALL), "timestamp"))], paths, None, P.CHAIN, P.FLOORS, full_refresh=True)
    assert tx_present(spark, paths, h)


def test_late_transaction_early_transfer_is_reattributed(spark, scratch):
    t, h = late_tx(spark)
    paths = MD.ModelPaths.under(scratch)
    run(spark, paths, t - dt.timedelta(days=1), False)
    run(spark, paths, t + dt.timedelta(hours=1), True, hold_tx=True)
    flags = transfer_flags(spark, paths, h)
    assert flags and not any(flags)  # event 550 has a transfer on the kept chain
    run(spark, paths, t + dt.timedelta(hours=7), True)
    assert all(transfer_flags(spark, paths, h))
