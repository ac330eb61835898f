"""Incremental behaviour: idempotence, 6-hourly increments = full refresh, lateness,
and the keyed upsert's edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas
from codetrail.functions.windows import metric_window, target_bound
from codetrail.operators import upsert
from codetrail.plans import models as MD

from .conftest import SF_SMALL


def rows(df, cols=None):
    df = df.select(*(cols or df.columns))
    return sorted(tuple(r) for r in df.collect())


def srcs(spark, sf=SF_SMALL):
    return Q.tx_source(spark, sf), Q.transfer_source(spark, sf), Q.price_source(spark, sf)


def run_at(spark, paths, as_of, incremental, sf=SF_SMALL):
    tx, tr, pr = srcs(spark, sf)
    return MD.run_all(spark, Q.cut(tx, as_of), Q.cut(tr, as_of), Q.cut(pr, as_of, "timestamp"), paths,
                      as_of if incremental else None, P.CHAIN, P.FLOORS)


def tables(spark, paths):
    ta = rows(Q.read_tx_table(spark, paths.transactions_attributed).drop("access_list"))
    tra = rows(Q.read_transfer_table(spark, paths.transfers_attributed).drop("trace_address"))
    dm = rows(spark.read.parquet(paths.daily_metric).select(
        "day", "builder_code", F.round("volume_usd", 6), "tx_count", "token_transfers_tx", "unique_addresses",
        F.round("chain_fees_usd", 12)))
    return ta, tra, dm


def test_run_twice_is_idempotent(spark, scratch):
    paths = MD.ModelPaths.under(scratch)
    as_of = dt.datetime(2024, 1, 10, 6)
    run_at(spark, paths, dt.datetime(2024, 1, 10), False)
    run_at(spark, paths, as_of, True)
    once = tables(spark, paths)
    run_at(spark, paths, as_of, True)
    assert tables(spark, paths) == once


def test_six_hourly_increments_equal_full_refresh(spark, scratch):
    inc = MD.ModelPaths.under(scratch + "/inc")
    full = MD.ModelPaths.under(scratch + "/full")
    start, end = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 8)
    run_at(spark, inc, start, False)
    t = start
    while t < end:
        t += dt.timedelta(hours=6)
        run_at(spark, inc, t, True)
    run_at(spark, full, end, False)
    assert tables(spark, inc) == tables(spark, full)


def test_daily_steps_lose_rows_older_than_12_hours(spark, scratch):
    inc = MD.ModelPaths.under(scratch + "/inc")
    full = MD.ModelPaths.under(scratch + "/full")
    start, end = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 8)
    run_at(spark, inc, start, False)
    t = start
    while t < end:
        t += dt.timedelta(hours=24)
        run_at(spark, inc, t, True)
    run_at(spark, full, end, False)
    ta_inc, _, _ = tables(spark, inc)
    ta_full, _, _ = tables(spark, full)
    assert set(ta_inc) < set(ta_full)


def _frame(spark, data):
    return spark.createDataFrame(data, "k string, d date, v int")


def test_key_moves_partition_and_emptied_partition(spark, scratch):
    path = scratch + "/t"
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    upsert.delete_insert(spark, _frame(spark, [("a", d1, 1), ("b", d1, 2), ("c", d2, 3)]), path, ["k"], "d")
    # 'c' is alone in d2 and moves to d3; 'a' is updated in place.
    res = upsert.delete_insert(spark, _frame(spark, [("c", d3, 30), ("a", d1, 10)]), path, ["k"], "d")
    assert res.emptied_partitions == [d2]
    assert rows(spark.read.parquet(path), ["k", "d", "v"]) == [("a", d1, 10), ("b", d1, 2), ("c", d3, 30)]


def test_null_key_rejected(spark, scratch):
    with pytest.raises(upsert.UniqueKeyViolation):
        upsert.delete_insert(spark, _frame(spark, [(None, dt.date(2024, 1, 1), 1)]), scratch + "/t", ["k"], "d")


def test_merge_rejects_duplicate_batch_keys(spark, scratch):
    d1 = dt.date(2024, 1, 1)
    with pytest.raises(upsert.UniqueKeyViolation):
        upsert.merge(spark, _frame(spark, [("a", d1, 1), ("a", d1, 2)]), scratch + "/t", ["k"], "d")


def test_delete_insert_keeps_batch_duplicates(spark, scratch):
    d1 = dt.date(2024, 1, 1)
    path = scratch + "/t"
    upsert.delete_insert(spark, _frame(spark, [("a", d1, 1)]), path, ["k"], "d")
    upsert.delete_insert(spark, _frame(spark, [("a", d1, 2), ("a", d1, 3)]), path, ["k"], "d")
    assert rows(spark.read.parquet(path), ["k", "v"]) == [("a", 2), ("a", 3)]


def test_vanished_key_stays_unless_whole_day_replace(spark, scratch):
    day = dt.datetime(2024, 1, 1)
    schema = "day timestamp, builder_code string, n int"
    for replace, expect in ((False, [("x", 1), ("y", 5)]), (True, [("y", 5)])):
        path = f"{scratch}/dm-{replace}"
        upsert.delete_insert(spark, spark.createDataFrame([(day, "x", 1), (day, "y", 2)], schema), path,
                             schemas.DAILY_KEY, None)
        key = ["day"] if replace else schemas.DAILY_KEY
        upsert.delete_insert(spark, spark.createDataFrame([(day, "y", 5)], schema), path, key, None)
        assert rows(spark.read.parquet(path), ["builder_code", "n"]) == expect


def test_dedupe_latest_keeps_greatest(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only")],
                               "k string, ts int, v string")
    assert rows(upsert.dedupe_latest(df, "k", "ts")) == [("a", 3, "new"), ("b", 1, "only")]


def test_compaction_rewrites_fragmented_partitions(spark, scratch):
    path = scratch + "/frag"
    df = spark.range(0, 4000).select((F.col("id") % 4000).alias("id"),
                                     F.lit(dt.date(2024, 1, 1)).alias("d"))
    for i in range(6):
        df.where(F.col("id") % 6 == i).write.mode("append").partitionBy("d").parquet(path)
    before = sorted(r[0] for r in spark.read.parquet(path).select("id").collect())
    files = lambda: {r.directory: r.files for r in upsert.file_counts(spark, path, "d").collect()}
    assert files()["/d=2024-01-01"] >= 6
    assert upsert.compact(spark, path, "d", max_files=4) == ["d=2024-01-01"]
    assert files()["/d=2024-01-01"] == 1
    assert upsert.compact(spark, path, "d", max_files=0) == []
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == before


def test_compaction_settles_when_a_partition_needs_many_files(spark, scratch):
    path = scratch + "/big"
    df = spark.range(0, 60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), (F.col("id") % 2).cast("int").alias("m"),
                                      F.lit("a b/é").alias("n"))
    df.repartition(20).write.partitionBy("m", "n").parquet(path)
    done = upsert.compact(spark, path, ["m", "n"], max_files=2, target_file_bytes=400_000)
    assert len(done) == 2
    sizes = upsert.file_counts(spark, path, ["m", "n"]).collect()
    assert all(1 < r.files < 10 for r in sizes)
    assert upsert.compact(spark, path, ["m", "n"], max_files=2, target_file_bytes=400_000) == []
    assert spark.read.parquet(path).select("id").distinct().count() == 60000


def test_changed_columns_are_refused(spark, scratch):
    path = scratch + "/cols"
    d1 = dt.date(2024, 1, 1)
    wide = spark.createDataFrame([("a", d1, 1, 7), ("b", d1, 2, 8)], "k string, d date, v int, x int")
    upsert.delete_insert(spark, wide, path, "k", "d")
    with pytest.raises(upsert.SchemaChanged, match="x"):
        upsert.delete_insert(spark, wide.drop("x"), path, "k", "d")
    with pytest.raises(upsert.SchemaChanged, match="v"):
        upsert.delete_insert(spark, wide.withColumn("v", F.col("v").cast("long")), path, "k", "d")
    assert rows(spark.read.parquet(path), ["k", "x"]) == [("a", 7), ("b", 8)]


def test_null_partition_values(spark, scratch):
    path = scratch + "/nulls"
    d1 = dt.date(2024, 1, 1)
    with pytest.raises(upsert.UniqueKeyViolation, match="partition"):
        upsert.delete_insert(spark, _frame(spark, [("a", None, 1), ("b", d1, 2)]), path, "k", "d")
    # a table that has them already, written by other means, keeps those that the batch does not replace
    _frame(spark, [("a", None, 1), ("b", None, 2), ("c", d1, 3)]).write.partitionBy("d").parquet(path)
    upsert.delete_insert(spark, _frame(spark, [("a", d1, 9)]), path, "k", "d")
    assert rows(spark.read.parquet(path), ["k", "v"]) == [("a", 9), ("b", 2), ("c", 3)]
    upsert.delete_insert(spark, _frame(spark, [("b", d1, 8)]), path, "k", "d")
    assert rows(spark.read.parquet(path), ["k", "v"]) == [("a", 9), ("b", 8), ("c", 3)]


def test_too_many_partitions_are_refused(spark, scratch, monkeypatch):
    monkeypatch.setattr(upsert, "MAX_PARTITIONS", 2)
    days = [(f"k{i}", dt.date(2024, 1, 1 + i), i) for i in range(3)]
    with pytest.raises(upsert.TooManyPartitions):
        upsert.delete_insert(spark, _frame(spark, days), scratch + "/many", "k", "d")


def test_two_partition_columns(spark, scratch):
    path = scratch + "/two"
    schema = "k string, month string, d date, v int"
    row = lambda k, m, day, v: (k, m, dt.date(2024, m, day), v)
    make = lambda *rs: spark.createDataFrame([(k, f"2024-{m:02d}", d, v) for k, m, d, v in rs], schema)
    upsert.delete_insert(spark, make(row("a", 1, 1, 1), row("b", 1, 2, 2), row("c", 2, 1, 3)), path, "k", ["month", "d"])
    r = upsert.delete_insert(spark, make(row("b", 2, 1, 20), row("e", 3, 1, 5)), path, "k", ["month", "d"])
    assert r.emptied_partitions == [("2024-01", dt.date(2024, 1, 2))] and r.rows == 2
    assert rows(spark.read.parquet(path), ["k", "month", "v"]) == [("a", "2024-01", 1), ("b", "2024-02", 20), ("c", "2024-02", 3), ("e", "2024-03", 5)]


def test_target_bound_prunes_the_target_scan(spark, scratch):
    """With a bound on the dates, the old-key lookup reads those directories only."""
    path = scratch + "/bound"
    days = [(f"k{i}", dt.date(2024, 1, 1 + i), i) for i in range(10)]
    upsert.delete_insert(spark, _frame(spark, days), path, "k", "d")
    target = spark.read.schema(_frame(spark, days).schema).parquet(path)
    bound = target_bound(dt.datetime(2024, 1, 10), 2, "d")
    plan = target.where(bound).join(_frame(spark, days).select("k"), "k", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-08" in plan
    # rows before the bound are not looked at, as documented
    upsert.delete_insert(spark, _frame(spark, [("k9", dt.date(2024, 1, 9), 90), ("k0", dt.date(2024, 1, 10), 5)]), path, "k", "d", target_predicate=bound)
    got = rows(spark.read.parquet(path), ["k", "v"])
    assert ("k9", 90) in got and ("k9", 9) not in got and ("k0", 0) in got and ("k0", 5) in got


def test_replace_where(spark, scratch):
    path = scratch + "/replace"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    upsert.replace_where(spark, _frame(spark, [("a", d1, 1), ("b", d2, 2)]), path, F.lit(True))
    upsert.replace_where(spark, _frame(spark, []), path, F.col("d") == F.lit(d1))  # a day that emptied
    assert rows(spark.read.parquet(path), ["k", "v"]) == [("b", 2)]
    with pytest.raises(ValueError, match="outside"):
        upsert.replace_where(spark, _frame(spark, [("c", d2, 3)]), path, F.col("d") == F.lit(d1))


def test_window_of_an_instant_with_an_offset():
    zone = dt.timezone(dt.timedelta(hours=2))
    with_offset = metric_window(dt.datetime(2026, 5, 10, 1, 0, tzinfo=zone))
    assert with_offset.date_bound == metric_window(dt.datetime(2026, 5, 9, 23, 0)).date_bound == dt.date(2026, 5, 7)


def test_full_refresh_swaps_whole_table(spark, scratch):
    path = scratch + "/fr"
    upsert.full_refresh(spark, _frame(spark, [("a", dt.date(2024, 1, 1), 1)]), path, "d")
    upsert.full_refresh(spark, _frame(spark, [("b", dt.date(2024, 1, 2), 2)]), path, "d")
    assert rows(spark.read.parquet(path), ["k", "v"]) == [("b", 2)]


def test_empty_first_run_keeps_tables_readable(spark, scratch):
    """Nothing passes the floors: the (partitioned) tables hold no files yet stay readable,
    and later runs still work."""
    from codetrail.functions.windows import Floors

    late = Floors(dt.date(2030, 1, 1), dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 1))
    paths = MD.ModelPaths.under(scratch)
    tx, tr, pr = srcs(spark)
    for as_of in (None, dt.datetime(2024, 1, 20)):
        MD.run_all(spark, tx, tr, pr, paths, as_of, P.CHAIN, late)
    assert Q.read_tx_table(spark, paths.transactions_attributed).count() == 0
    assert Q.read_transfer_table(spark, paths.transfers_attributed).count() == 0
    assert spark.read.schema(schemas.DAILY_METRIC).parquet(paths.daily_metric).count() == 0


def test_switch_keeps_the_table_readable_and_drops_old_versions(spark, scratch):
    import os

    root, d1, d2 = scratch + "/sw", dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    for n in range(4):
        upsert.refresh_switch(spark, _frame(spark, [("a", d1, n), ("b", d2, n)]), "switched", root, "d")
        assert rows(spark.table("switched"), ["k", "v"]) == [("a", n), ("b", n)]
    assert len([x for x in os.listdir(root.removeprefix("file:")) if x.startswith("v-")]) == 2
    plan = spark.table("switched").where(F.col("d") == F.lit(d1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    with pytest.raises(upsert.EmptyRefresh):
        upsert.refresh_switch(spark, _frame(spark, []), "switched", root, "d")
    assert spark.table("switched").count() == 2
