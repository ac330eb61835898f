"""Old-key lookup by value: the reader skips what cannot hold the keys, and the table is the same as by a join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from codetrail.operators import upsert as U


def table(spark, n, add=0):
    return spark.range(n).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("k"), (F.col("id") + add).alias("v"),
                                 F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day"))


def scanned(df) -> int:
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_small_batch_reads_few_rows(spark, scratch):
    n, path = 200_000, f"{scratch}/t"
    U.delete_insert(spark, table(spark, n), path, "k", "day", lookup_limit=100)
    keys = table(spark, 3).select("k")
    before = spark.conf.get(U.IN_PUSHDOWN)
    found, looked_up = U.old_rows(spark.read.parquet(path), keys, ["k"], 100)
    with U._pushed_keys(spark, looked_up):
        read = scanned(found)
    assert looked_up == 3 and found.count() == 3 and 0 < read <= 3 * n / 40 + n / 40   # of 40 row groups, one may pass by chance
    missing, _ = U.old_rows(spark.read.parquet(path), spark.range(20).select(F.unhex(F.sha2(F.concat(F.lit("x"), "id"), 256)).alias("k")), ["k"], 100)
    with U._pushed_keys(spark, 20):
        assert scanned(missing) < n / 2                                # most Bloom filters hold none of them
    assert spark.conf.get(U.IN_PUSHDOWN) == before
    assert U.old_rows(spark.read.parquet(path), table(spark, 101).select("k"), ["k"], 100)[1] == 0   # too many: by a join


@pytest.mark.parametrize("limit", [0, 5, 1000])
def test_same_table_with_and_without(spark, scratch, limit):
    path = f"{scratch}/t"
    U.delete_insert(spark, table(spark, 50), path, "k", "day", lookup_limit=limit)
    moved = table(spark, 8, add=100).withColumn("day", F.lit(dt.date(2024, 3, 9)))
    r = U.delete_insert(spark, moved, path, "k", "day", lookup_limit=limit)
    assert len(r.touched_partitions) == 9 and r.rows == 8
    got = {bytes(x.k): (x.v, x.day) for x in spark.read.parquet(path).collect()}
    want = {bytes(x.k): (x.v, x.day) for x in table(spark, 50).collect()} | {bytes(x.k): (x.v, x.day) for x in moved.collect()}
    assert got == want
    with pytest.raises(U.UniqueKeyViolation):
        U.delete_insert(spark, moved.withColumn("k", F.lit(None).cast("binary")), path, "k", "day", lookup_limit=limit)


def test_thousands_of_keys_are_looked_up_by_value(spark, scratch):
    """One flat IN list of so many keys overflowed the stack of the Parquet reader's filter."""
    n, path = 12_000, f"{scratch}/t"
    U.delete_insert(spark, table(spark, n), path, "k", "day", lookup_limit=10_000)
    batch = table(spark, 9_001, add=100)
    keys = batch.select("k")
    found, looked_up = U.old_rows(spark.read.parquet(path), keys, ["k"], 10_000)
    assert looked_up == 9_001 and found.count() == 9_001
    U.delete_insert(spark, batch, path, "k", "day", lookup_limit=10_000)
    assert spark.read.parquet(path).groupBy().agg(F.count("k"), F.sum("v")).first() == (n, n * (n - 1) // 2 + 9_001 * 100)
