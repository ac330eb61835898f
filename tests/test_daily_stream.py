"""The daily stream: prices that come late repair their days, the day log, vanished transfers, no silent cap."""

import pytest
from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas as S
from codetrail.operators import upsert as U
from codetrail.plans.models import ModelPaths
from codetrail.streaming import attribution_stream as ST

from .conftest import SF_SMALL


def fees(spark, paths):
    df = spark.read.schema(S.DAILY_METRIC).parquet(paths.daily_metric)
    return {(r.day.date(), r.builder_code): r.chain_fees_usd for r in df.collect()}


def test_late_prices_repair_their_days_only(spark, scratch):
    paths = ModelPaths.under(f"{scratch}/out")
    keep = F.col("block_date").between("2024-01-03", "2024-01-06")
    tx, tr = Q.tx_source(spark, SF_SMALL).where(keep), Q.transfer_source(spark, SF_SMALL).where(keep)
    pr = Q.price_source(spark, SF_SMALL)
    tx.write.partitionBy("block_date").parquet(f"{scratch}/tx")
    tr.write.partitionBy("block_date").parquet(f"{scratch}/tr")
    run = lambda: ST.start_daily_stream(spark, f"{scratch}/tx", f"{scratch}/tr", f"{scratch}/pr", paths, f"{scratch}/ckpt",
                                        P.CHAIN, P.FLOORS).awaitTermination()
    day = F.to_date("timestamp")
    pr.where(day == "2024-01-03").write.parquet(f"{scratch}/pr")
    run()
    before = fees(spark, paths)
    assert any(v > 0 for (d, _), v in before.items() if d.day == 3) and not any(v for (d, _), v in before.items() if d.day == 5)
    pr.where(day == "2024-01-05").write.mode("append").parquet(f"{scratch}/pr")
    run()
    after = fees(spark, paths)
    assert {k: v for k, v in before.items() if k[0].day != 5} == {k: v for k, v in after.items() if k[0].day != 5}
    assert any(v > 0 for (d, _), v in after.items() if d.day == 5)
    log = {(r.day.day, r.source, r.batch) for r in ST.day_log(spark, ST.day_log_path(paths)).collect()}
    assert (5, "prices", 1) in log and (3, "prices", 0) in log and not any(s != "prices" for _, s, b in log if b == 1)
    whole = Q.daily_output(spark.read.schema(S.DAILY_METRIC).parquet(paths.daily_metric)).collect()
    want = Q.daily_output(Q.M.daily_metrics(
        Q.read_transfer_table(spark, paths.transfers_attributed), Q.read_tx_table(spark, paths.transactions_attributed),
        pr.where(day.isin("2024-01-03", "2024-01-05")), P.CHAIN, P.FLOORS)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, want))


def test_a_batch_that_runs_again_replaces_its_log_rows(spark, scratch):
    touched = spark.sql("SELECT DATE'2024-01-01' + i AS day, 'prices' AS source FROM (SELECT explode(sequence(0, 4)) AS i)")
    assert len(ST.log_days(spark, scratch, 7, touched)) == 5
    assert len(ST.log_days(spark, scratch, 7, touched)) == 5
    assert len(ST.log_days(spark, scratch, 8, touched.limit(0))) == 0
    assert ST.day_log(spark, scratch).count() == 5


def test_too_many_days_raise(spark, scratch, monkeypatch):
    monkeypatch.setattr(U, "MAX_PARTITIONS", 3)
    touched = spark.sql("SELECT DATE'2024-01-01' + i AS day, 'transfers' AS source FROM (SELECT explode(sequence(0, 4)) AS i)")
    with pytest.raises(U.TooManyPartitions):
        ST.log_days(spark, scratch, 0, touched)


def test_the_latest_of_differing_duplicates_stays(spark, scratch):
    ta = Q.ta_full(spark, SF_SMALL).limit(20).cache()
    later = ta.withColumns({"block_time": F.col("block_time") + F.expr("INTERVAL 1 SECOND"), "gas_used": F.col("gas_used") + 1})
    for i, both in enumerate((ta.unionByName(later), later.unionByName(ta))):
        ST._upsert_batch(both.repartition(5), f"{scratch}/{i}", True, None)
    a, b = (sorted(map(str, Q.read_tx_table(spark, f"{scratch}/{i}").collect())) for i in (0, 1))
    assert a == b and len(a) == 20 and a == sorted(map(str, later.select(*S.TX_ATTRIBUTED_COLUMNS).collect()))
