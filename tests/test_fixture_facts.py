"""The expected facts of FIXTURES.md 3.4 (computed independently from the same recipe)."""

import datetime as dt

from pyspark.sql import functions as F

from checks import fixtures
from checks import spark_queries as Q
from codetrail.functions.windows import Floors
from codetrail.operators import attribution as A
from codetrail.operators import metrics as M

from .conftest import SF_MID

START = Floors(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))


def test_documented_facts_at_sf001(spark):
    tx, tr, pr = Q.tx_source(spark, SF_MID), Q.transfer_source(spark, SF_MID), Q.price_source(spark, SF_MID)
    ta = A.attribute_transactions(tx, START)
    tra = A.attribute_transfers(A.select_transfers(tr, "celo", START), A.attribution_keys(ta, START))
    dm = M.daily_metrics(tra, ta, pr, "celo", START).cache()
    try:
        assert ta.count() == 8182
        assert tr.count() == 15000 and tr.where("blockchain = 'celo'").count() == 14000
        assert dm.count() == 1058
        assert dm.where("volume_usd = 0 AND token_transfers_tx = 0").count() == 111
        assert dm.where("chain_fees_usd = 0").count() == 139
        assert dm.where("tx_count != unique_addresses").count() == 238
        first = dm.orderBy("day", "builder_code").first()
        assert (first["day"], first["builder_code"]) == (dt.datetime(2024, 1, 1), "app0")
        assert (first["volume_usd"], first["tx_count"], first["token_transfers_tx"], first["unique_addresses"]) == (
            32.57, 1, 1, 1)
        assert abs(first["chain_fees_usd"] - 0.00048952875) < 1e-15
    finally:
        dm.unpersist()


def test_one_file_of_events_is_derived_by_many_tasks(spark, scratch):
    """Few, well compressed files hold many events: no task takes all days or sorts its wide rows by day."""
    n = 90_000
    (spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 7919 % (30 * 86_400)).alias("ts"),
                           (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"))
     .coalesce(1).write.parquet(f"{scratch}/events.parquet"))
    for derive, rows in ((fixtures.transactions, n), (fixtures.transfers, n * 3 // 2)):
        df = derive(spark, scratch).select("block_date", F.spark_partition_id().alias("task"))
        tasks = df.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("block_date").alias("days")).collect()
        assert sum(t.n for t in tasks) == rows
        assert len(tasks) == 4 and max(t.n for t in tasks) < rows / 2 and max(t.days for t in tasks) < 16
