"""Transfers are attributed where they are written: one wide shuffle, the rows of the plain join, few files a day."""

import datetime as dt

from pyspark.sql import functions as F, types as T

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas as S
from codetrail.operators import attribution as A
from codetrail.operators import upsert as U
from codetrail.plans import models as MD
from codetrail.session import ALL_KEYS, join_as_dealt

from .conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in range(3, 7)]


def typed(spark, rows, schema):
    """Rows given by some of the schema's columns, the others null."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], nullable)


def transfers(spark):
    """Twelve transfers of six hashes on four days: one hash on two days, one without a hash on each day."""
    rows = []
    for i in range(12):
        day = DAYS[i % 4]
        h = None if i % 6 == 5 else bytes([i % 5]) * 32
        rows.append({"unique_key": f"k{i}", "blockchain": "celo", "block_date": day, "block_time": dt.datetime.combine(day, dt.time(9)), "tx_hash": h, "evt_index": i})
    return typed(spark, rows, S.TRANSFERS)


def keys(spark):
    """Attribution: hash 0 twice, hash 1 untagged, hash 2 tagged, hash 9 without transfers, one without a hash."""
    some = [(bytes([0]) * 32, True, "a", "a", None), (bytes([0]) * 32, True, "b", "b", None), (bytes([1]) * 32, False, None, None, None),
            (bytes([2]) * 32, True, "c,d", "c", "d"), (bytes([9]) * 32, True, "z", "z", None), (None, True, "n", "n", None)]
    return spark.createDataFrame(some, "hash binary, has_builder_code boolean, multi_code string, builder_code string, builder_code2 string")


def text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_rows_of_the_plain_join(spark):
    tr = A.select_transfers(transfers(spark), "celo", P.FLOORS)
    want = text(A.attribute_transfers(tr, keys(spark)))
    assert len(want) > 12
    for counts in (A.rows_by_day(tr, 10), {}, {DAYS[0]: 10 * A.TRANSFERS_PER_FILE}):   # known, unknown and outdated days
        assert text(A.attribute_by_day(tr, keys(spark), counts)) == want
    assert A.rows_by_day(tr, 3) is None


def test_wide_transfers_move_once(spark, scratch, monkeypatch):
    monkeypatch.setattr(A, "TRANSFERS_PER_FILE", 40)
    monkeypatch.setattr(U, "balanced", lambda *a: (_ for _ in ()).throw(AssertionError("gathered by day again")))
    before = spark.conf.get(ALL_KEYS), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tr, tx = Q.transfer_source(spark, SF_SMALL), Q.tx_source(spark, SF_SMALL)
        MD.run_transactions(spark, tx, f"{scratch}/tx", None, P.FLOORS)
        MD.run_transfers(spark, tr, f"{scratch}/tx", f"{scratch}/tr", None, P.CHAIN, P.FLOORS)
        assert spark.conf.get(ALL_KEYS) == before[0]
        some, ta = A.select_transfers(tr, P.CHAIN, P.FLOORS), A.attribution_keys(Q.read_tx_table(spark, f"{scratch}/tx"), P.FLOORS)
        with join_as_dealt(spark):
            plan = A.attribute_by_day(some, ta, A.rows_by_day(some, 100))._jdf.queryExecution().executedPlan().toString()
        written = spark.read.schema(S.TRANSFERS_ATTRIBUTED).parquet(f"{scratch}/tr")
        assert text(written.select(*some.columns)) == text(some)
        files = U.file_counts(spark, f"{scratch}/tr", "block_date").collect()
        rows = {str(d): n for d, n in A.rows_by_day(some, 100).items()}
        assert files and all(f["files"] <= -(-rows[f["directory"].split("=")[1]] // 40) for f in files)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning(_day" in x]
    assert len(wide) == 2 and not any("hash#" in x for x in wide)   # by day and file alone, on both sides


def test_emptied_day_rewrites_transactions_without_a_shuffle(spark, monkeypatch):
    """daily_replace_days: the table of transactions comes from a source partitioned by the same day."""
    wide, write = [], U.write_table
    monkeypatch.setattr(U, "write_table", lambda df, path, by=None, mode="overwrite", rebalance=True: (
        wide.append((by, rebalance)), write(df, path, by, mode, rebalance))[1])
    Q.q_daily_replace_days(spark, SF_SMALL)
    assert [r for by, r in wide if by] == [False, False, False]
