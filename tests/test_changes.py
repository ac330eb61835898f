"""Export of changes, exactly-once append, bucketed join, and the pruned export window."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas as S
from codetrail.operators import export as X
from codetrail.operators import upsert as U

from .conftest import SF_SMALL

SCHEMA = "k long, day date, v string"
D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
T0 = dt.datetime(2024, 2, 1)


def rows(df):
    return sorted((r.k, r.day, r.v) for r in df.collect())


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_only_changes_are_sent_and_written(spark, scratch):
    dest = f"{scratch}/t"
    df = lambda data: spark.createDataFrame(data, SCHEMA)
    first = [(1, D[0], "a"), (2, D[0], None), (3, D[1], "c"), (4, D[2], "d"), (5, D[3], "e")]
    assert X.export_changes(spark, df(first), dest, "k", "day", T0).count() == 5
    before = files(dest)
    # 3 changes, 4 moves to another day and leaves its own empty, 5 vanishes, 6 is new
    now = [(1, D[0], "a"), (2, D[0], None), (3, D[1], "C"), (4, D[1], "d"), (6, D[1], None)]
    changes = X.export_changes(spark, df(now), dest, "k", "day", T0 + dt.timedelta(days=1))
    assert sorted((r.k, r.op) for r in changes.collect()) == [(3, "upsert"), (4, "upsert"), (5, "delete"), (6, "upsert")]
    stored = spark.read.schema(SCHEMA).parquet(dest)
    assert rows(stored) == sorted(now)
    kept = {f for f in files(dest) if f"day={D[0]}" in f}
    assert kept == {f for f in before if f"day={D[0]}" in f}
    assert X.export_changes(spark, df(now), dest, "k", "day", T0 + dt.timedelta(days=2)).count() == 0
    # a run that failed before its state was written is repeated: its new rows are not doubled
    more = now + [(7, D[1], "x"), (8, D[3], "y")]
    U.apply_changes(spark, df(more[-2:]), df([]).select("k", "day"), dest, "k", "day")
    X.export_changes(spark, df(more), dest, "k", "day", T0 + dt.timedelta(days=3))
    assert rows(spark.read.schema(SCHEMA).parquet(dest)) == sorted(more)
    with pytest.raises(U.UniqueKeyViolation):
        X.export_changes(spark, df([(None, D[0], "z")]), dest, "k", "day", T0 + dt.timedelta(days=4))


def test_a_batch_is_appended_once(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(1, D[0], "a"), (2, D[1], "b")], SCHEMA)
    assert U.append_once(spark, df, path, "b1", "day").touched_partitions == ["b1"]
    before = files(path)
    assert U.append_once(spark, df, path, "b1", "day").rows == 0 and files(path) == before
    # half a batch without a ledger entry is not read, and its retry replaces it
    df.limit(1).withColumn(U.BATCH, F.lit("b2")).write.mode("append").partitionBy(U.BATCH, "day").parquet(path)
    assert rows(U.read_appended(spark, path, df.schema)) == rows(df)
    U.append_once(spark, df.withColumn("k", F.col("k") + 10), path, "b2", "day")
    assert [r[0] for r in rows(U.read_appended(spark, path, df.schema))] == [1, 2, 11, 12]
    with pytest.raises(U.SchemaChanged):
        U.append_once(spark, df.withColumn("w", F.lit(1)), path, "b3", "day")


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = Q.bucketed_models(spark, SF_SMALL, 4)
        plan = Q.attributed_from_buckets(spark, *names)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_export_window_prunes_directories(spark, scratch):
    U.full_refresh(spark, Q.ta_full(spark, SF_SMALL), scratch, S.TX_PARTITION)
    w = X.ExportWindow("block_time", S.TX_KEY, P.EXPORT_START, P.EXPORT_START + dt.timedelta(days=1), False)
    df = Q.read_tx_table(spark, scratch)
    got = X.window_rows(df, w, S.TX_PARTITION)
    assert "PartitionFilters: [isnotnull(block_date" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == X.window_rows(df, w).count() > 0


def test_the_source_is_derived_twice_a_run(spark, scratch):
    """Once for the keys and digests, once for the rows to send, however often the differences are used."""
    seen = spark.sparkContext.accumulator(0)

    def touch(v):
        seen.add(1)
        return v

    n, touched = 300, F.udf(touch, "string")
    df = lambda add: spark.range(n).select(F.col("id").alias("k"), F.lit(D[0]).alias("day"), touched((F.col("id") % 7 + add).cast("string")).alias("v"))
    X.export_changes(spark, df(0), f"{scratch}/t", "k", "day", T0)
    seen.value = 0
    changes = X.export_changes(spark, df(1), f"{scratch}/t", "k", "day", T0 + dt.timedelta(days=1))
    assert seen.value <= 2 * n
    assert changes.where("op = 'upsert'").count() == n
