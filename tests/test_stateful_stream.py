"""T6 with state: re-deliveries never reach the table, late rows go to the side table, across restarts."""

from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas as S
from codetrail.sources.catalog import read_table
from codetrail.streaming import attribution_stream as ST

from .conftest import SF_SMALL


def test_late_rows_and_repeats(spark, scratch):
    src, main, late, ckpt = f"{scratch}/src", f"{scratch}/main", f"{scratch}/late", f"{scratch}/ckpt"
    tx, day = Q.tx_source(spark, SF_SMALL), F.dayofmonth("block_date")
    table = lambda p: read_table(spark, p, S.TX_ATTRIBUTED)

    def arrive(df):
        df.write.mode("append").parquet(src)
        ST.run_dedup_streams(spark, src, main, late, ckpt, P.FLOORS)

    arrive(tx.where((day > 10) & (day <= 20)))
    assert table(main).count() > 0 and table(late).count() == 0
    files = set(table(main).inputFiles())
    arrive(tx.where((day > 18) & (day <= 20)))                         # repeats only: dropped by the state
    assert set(table(main).inputFiles()) == files
    arrive(tx.where(day <= 5))                                         # older than the watermark
    assert set(table(main).inputFiles()) == files
    want = Q.ta_full(spark, SF_SMALL).select(*[F.col(f"`{c}`") for c in S.TX_ATTRIBUTED_COLUMNS]).where((day <= 5) | ((day > 10) & (day <= 20)))
    assert table(late).where(day <= 5).count() == want.where(day <= 5).count() == table(late).count()
    got = ST.read_with_late(spark, main, late)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    changed = tx.where(day == 20).withColumn("gas_used", F.col("gas_used") + 1)
    arrive(changed.unionByName(changed.withColumn("gas_used", F.col("gas_used") + 1)))   # versions: the latest batch, then the greatest
    twice = want.withColumn("gas_used", F.when(day == 20, F.col("gas_used") + 2).otherwise(F.col("gas_used")).cast("long"))
    got = ST.read_with_late(spark, main, late)
    assert got.exceptAll(twice).count() == 0 and twice.exceptAll(got).count() == 0


def test_state_is_kept_in_rocksdb_and_the_setting_comes_back(spark, scratch):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    Q.tx_source(spark, SF_SMALL).limit(50).write.parquet(f"{scratch}/src")
    q = ST.start_stateful_stream(spark, f"{scratch}/src", f"{scratch}/main", f"{scratch}/ckpt", P.FLOORS)
    q.awaitTermination()
    state = q.lastProgress["stateOperators"][0]
    assert state["operatorName"] == "dedupeWithinWatermark" and any(k.startswith("rocksdb") for k in state["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
