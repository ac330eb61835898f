"""Stream restarts: files that arrive after a stop are picked up from the checkpoint, and
the table ends equal to a single run over all files."""

from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail.streaming import attribution_stream as ST

from .conftest import SF_SMALL


def test_restart_from_checkpoint_equals_one_run(spark, scratch):
    tx = Q.tx_source(spark, SF_SMALL)
    src, target, ckpt = f"{scratch}/src", f"{scratch}/ta", f"{scratch}/_ckpt"
    tx.where(F.col("block_date") < F.lit("2024-01-15").cast("date")).write.mode("append").parquet(src)
    ST.start_transactions_stream(spark, src, target, ckpt, P.FLOORS).awaitTermination()
    first = spark.read.parquet(target).count()
    # more files arrive, including re-delivered rows of the first days; restart on the same checkpoint
    tx.where(F.col("block_date") >= F.lit("2024-01-10").cast("date")).write.mode("append").parquet(src)
    ST.start_transactions_stream(spark, src, target, ckpt, P.FLOORS).awaitTermination()
    got = Q.read_tx_table(spark, target).drop("access_list")
    want = Q.ta_full(spark, SF_SMALL).drop("access_list")
    assert first < got.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
