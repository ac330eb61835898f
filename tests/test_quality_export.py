"""Quality rules (one passing and one failing table each) and export window resolution."""

import datetime as dt

import pytest

from checks import spark_queries as Q
from codetrail.operators import export as X
from codetrail.operators import quality as QL

from .conftest import SF_SMALL


def by_column(df):
    return {r["column"]: r["failing_rows"] for r in df.collect()}


def test_dq_rules_pass_and_fail(spark):
    u = by_column(Q.q_dq_unique(spark, SF_SMALL))
    assert u["event_id"] == 0 and u["o_custkey"] > 0 and u["hash"] == 0 and u["unique_key"] == 0
    uc = by_column(Q.q_dq_unique_combination(spark, SF_SMALL))
    assert uc["l_orderkey,l_linenumber"] > 0 and uc["tx_hash,evt_index"] == 0 and uc["day,builder_code"] == 0
    av = by_column(Q.q_dq_accepted_values(spark, SF_SMALL))
    assert av["o_orderstatus:F,O,P"] == 0 and av["o_orderstatus:F,O"] == 1 and av["blockchain:celo"] == 0
    rel = by_column(Q.q_dq_relationships(spark, SF_SMALL))
    assert rel["n_regionkey->region.r_regionkey"] == 0 and rel["tx_hash->transactions_attributed.hash"] > 0
    nn = {(r["model"], r["column"]): r["failing_rows"] for r in Q.q_dq_not_null(spark, SF_SMALL).collect()}
    assert nn[("transfers", "amount_usd")] > 0
    assert all(v == 0 for k, v in nn.items() if k[0] != "transfers")
    assert all(r["failing_rows"] == 0 for r in Q.q_dq_invariants(spark, SF_SMALL).collect())


def test_model_rules_summary(spark):
    ta = Q.ta_full(spark, SF_SMALL)
    out = QL.failing(QL.TRANSACTIONS_RULES.run(ta)).collect()
    assert out == []


AS_OF = dt.datetime(2024, 1, 20)


def test_export_window_resolution():
    meta = {"export": {"enabled": True, "time_column": "block_time", "time_start": dt.datetime(2024, 1, 1),
                       "time_start_incremental": lambda a: a - dt.timedelta(days=1)}}
    full = X.resolve_window(meta, "incremental", "hash", AS_OF, is_incremental=False)
    assert full.full_refresh and full.time_start == dt.datetime(2024, 1, 1) and full.time_end == AS_OF
    assert full.unique_key == ["hash"]
    inc = X.resolve_window(meta, "incremental", "hash", AS_OF, is_incremental=True)
    assert not inc.full_refresh and inc.time_start == AS_OF - dt.timedelta(days=1)
    explicit = X.resolve_window(meta, "incremental", "hash", AS_OF, True, time_start=dt.datetime(2024, 1, 5),
                                unique_key=["a", "b"])
    assert explicit.time_start == dt.datetime(2024, 1, 5) and explicit.unique_key == ["a", "b"]
    table = X.resolve_window(meta, "table", "hash", AS_OF, is_incremental=True)
    assert table.full_refresh
    no_inc = {"export": {"enabled": True, "time_column": "t", "time_start": dt.datetime(2024, 1, 2)}}
    assert X.resolve_window(no_inc, "incremental", "k", AS_OF, True).time_start == dt.datetime(2024, 1, 2)
    assert X.resolve_window({"export": {"enabled": True, "time_column": "t"}}, "table", "k", AS_OF,
                            True).time_start is None


@pytest.mark.parametrize("meta,mat", [
    (None, "incremental"),
    ({"export": "yes"}, "incremental"),
    ({"export": {"enabled": "true"}}, "incremental"),
    ({"export": {"enabled": True}}, "view"),
])
def test_export_skips(meta, mat):
    with pytest.raises(X.ExportSkipped):
        X.resolve_window(meta, mat, "k", AS_OF, True)


def test_failing_row_queries(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "x")], "k int, v string")
    assert QL.not_null_failures(df, "v").count() == 1
    assert [tuple(r) for r in QL.unique_failures(df, "k").collect()] == [(2, 2)]
    assert QL.unique_combination_failures(df, ["k", "v"]).count() == 0
    assert [tuple(r) for r in QL.accepted_values_failures(df, "v", ["a", "b"]).collect()] == [("x", 1)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert sorted(r["k"] for r in QL.relationships_failures(df, "k", parent, "id").collect()) == [2, 2]


def test_spot_check_returns_at_most_n_rows(spark):
    from codetrail.operators import reports as R

    ta = Q.ta_full(spark, SF_SMALL)
    rows = R.spot_check(ta, 5).collect()
    assert len(rows) == 5 and set(rows[0].asDict()) == set(ta.columns)


def test_export_window_without_start(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.range(10).select(F.col("id").cast("string").alias("k"),
                                (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0,0,0,id)")).alias("t"))
    w = X.ExportWindow("t", ["k"], None, dt.datetime(2024, 1, 6), True)
    assert X.window_rows(df, w).count() == 5
    n = X.sync(spark, df, "demo", w, f"{scratch}/dest", f"{scratch}/log", dt.datetime(2024, 1, 6))
    assert n == 5
    latest = X.latest_runs(spark, f"{scratch}/log", 1).first()
    assert latest["time_start"] is None and latest["rows_synced"] == 5 and latest["full_refresh"]


def test_window_rules_of_table_models_and_empty_settings():
    meta = {"export": {"enabled": True, "time_column": "t", "time_start": dt.datetime(2024, 1, 2), "time_start_incremental": None}}
    # a table model is always exported whole, whatever is asked
    assert X.resolve_window(meta, "table", "k", AS_OF, True, full_refresh=False).full_refresh
    # an empty incremental start falls back to the start
    assert X.resolve_window(meta, "incremental", "k", AS_OF, True).time_start == dt.datetime(2024, 1, 2)


def test_rows_synced_counts_the_batch(spark, scratch):
    """A re-sync from which rows vanished logs what it sent, though the destination keeps them."""
    from pyspark.sql import functions as F

    df = spark.range(10).select(F.col("id").cast("string").alias("k"), (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0,0,0,id)")).alias("t"))
    w = X.ExportWindow("t", ["k"], dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), False)
    assert X.sync(spark, df, "demo", w, f"{scratch}/d2", f"{scratch}/l2", dt.datetime(2024, 1, 6)) == 10
    assert X.sync(spark, df.where("k < 4"), "demo", w, f"{scratch}/d2", f"{scratch}/l2", dt.datetime(2024, 1, 7)) == 4
    assert spark.read.parquet(f"{scratch}/d2").count() == 10


def test_key_rules_from_one_pass_equal_the_single_rules(spark):
    from codetrail.operators import quality as Q

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",)], "k string")
    got = {r.rule: r.failing_rows for r in Q.ModelRules("m", unique=["k"], unique_combinations=[["k"]]).run(df).collect()}
    assert got == {"unique": Q.unique_failures(df, "k").count(), "unique_combination_of_columns": Q.unique_combination_failures(df, ["k"]).count()} == {
        "unique": 1, "unique_combination_of_columns": 2}
