"""Physical-plan checks: pushdown and pruning reach the scan, no Cartesian products, no
Python evaluation, aggregation before the joins."""

import datetime as dt

from checks import params as P
from checks import spark_queries as Q
from codetrail.functions.windows import tx_window
from codetrail.operators import attribution as A

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_window_prunes_partitions_and_pushes_time(spark):
    tx = Q.tx_source(spark, SF_SMALL)
    p = formatted(A.attribute_transactions(tx, P.FLOORS, tx_window(dt.datetime(2024, 1, 20, 6))))
    assert "PartitionFilters: [isnotnull(block_date" in p and "2024-01-19" in p
    assert "GreaterThanOrEqual(block_time,2024-01-19 18:00:00.0)" in p


def test_projection_is_pruned(spark):
    p = formatted(Q.q_tx_metrics(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
    assert scan and all("gas_limit" not in s and "access_list" not in s for s in scan)


def test_daily_metrics_plan_shape(spark):
    df = Q.q_daily_metrics(spark, SF_SMALL)
    df.collect()
    p = plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "Expand" in p  # exact distinct counts, shuffled by (day, code, value)
    assert "partial_sum" in p  # map-side combine before the shuffle


def test_daily_metrics_decodes_no_calldata(spark):
    """The daily metric reads the written models: one narrow scan each of transfers, transactions and prices."""
    p = formatted(Q.q_daily_metrics(spark, SF_SMALL))
    scans = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
    assert len(scans) == 3 and all("data:" not in x and "calldata" not in x for x in scans)


def test_top_k_is_take_ordered(spark):
    p = plan(Q.q_top_codes(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_hot_tx_hash_is_split_by_aqe(spark):
    """A third of all transfers on one transaction: AQE splits the skewed left partition of J1."""
    from pyspark.sql import functions as F

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from codetrail import schemas

        n = 120000
        h = F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string"), 256))
        own = {"unique_key": F.col("id").cast("string"), "tx_hash": h}
        tr = spark.range(n).select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.TRANSFERS.fields])
        keys = spark.range(n).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"),
                                     F.lit(True).alias("has_builder_code"), F.lit("x").alias("multi_code"),
                                     F.lit("x").alias("builder_code"), F.lit(None).cast("string").alias("builder_code2"))
        j = A.attribute_transfers(tr, keys).select("unique_key", "multi_code")
        assert len(j.collect()) == n
        p = plan(j)
        assert "SortMergeJoin(skew=true)" in p and "AQEShuffleRead skewed" in p
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_time_bounds_do_not_depend_on_driver_time_zone(spark):
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        tx = Q.tx_source(spark, SF_SMALL)
        p = formatted(A.attribute_transactions(tx, P.FLOORS, tx_window(dt.datetime(2024, 1, 20, 6))))
        assert "GreaterThanOrEqual(block_time,2024-01-19 18:00:00.0)" in p
        assert "GreaterThanOrEqual(block_time,2024-01-02 07:30:00.0)" in p
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_operators_refuse_another_time_zone(spark):
    """Days are UTC days: in another zone the operators refuse to run, and leave the session as it is."""
    import pytest

    from codetrail.session import WrongTimeZone

    tx = Q.tx_source(spark, SF_SMALL)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(WrongTimeZone):
            A.attribute_transactions(tx, P.FLOORS)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dedupe_of_a_hot_key_is_combined_map_side(spark):
    """A third of all rows share one key: the max is partially aggregated before the shuffle."""
    from pyspark.sql import functions as F

    from codetrail.operators.upsert import dedupe_latest

    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("ts"), (F.col("id") * 2).alias("v"))
    out = dedupe_latest(df, "k", "ts")
    rows = {r["k"]: (r["ts"], r["v"]) for r in out.collect()}
    assert len(rows) == n - n // 3 + 1 and rows[-1] == (n - 3, 2 * (n - 3))
    p = plan(out)
    assert "partial_max" in p and "Window" not in p
