"""The job entry point over catalog sources: first run, incremental run, tests."""

import datetime as dt

import pytest

from checks import params as P
from checks import spark_queries as Q
from codetrail.plans import models
from codetrail.plans import run as R
from checks import fixtures

from .conftest import SF_SMALL


def test_select_models():
    assert R.select_models(None) == R.ORDER
    assert R.select_models(["+transfers_attributed"]) == R.ORDER[:2]
    assert R.select_models(["transfers_attributed+"]) == R.ORDER[1:]
    assert R.select_models(["buildercode_daily_metric"]) == R.ORDER[2:]
    with pytest.raises(SystemExit):
        R.select_models(["nope"])


def test_run_and_test_models(spark, scratch):
    fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    paths = models.ModelPaths.under(scratch)
    first = R.run(spark, cat, paths, R.ORDER, None, floors=P.FLOORS)
    assert all(r.first_run for r in first.values())
    again = R.run(spark, cat, paths, R.ORDER, dt.datetime(2024, 1, 31), floors=P.FLOORS)
    assert not any(r.first_run for r in again.values())
    assert R.test(spark, paths, R.ORDER) == []


def test_shuffle_partitions_sized_from_input(spark, scratch):
    from codetrail.session import input_bytes, shuffle_partitions_for

    fixtures.materialize(spark, SF_SMALL)
    cat, paths = fixtures.fixture_catalog(spark, SF_SMALL), models.ModelPaths.under(scratch)
    whole = R.read_sizes(spark, cat, paths, dt.datetime(2024, 1, 30))  # first run: everything
    assert all(whole) and whole[0] == input_bytes(spark, cat.path("celo", "transactions"))
    floor = 2 * spark.sparkContext.defaultParallelism
    assert shuffle_partitions_for(spark, whole) == floor          # small input: the floor
    assert shuffle_partitions_for(spark, [10 ** 14], 10 ** 8) == 10 ** 6  # and no limit above
    R.run(spark, cat, paths, R.ORDER[:1], None, floors=P.FLOORS)
    window = R.read_sizes(spark, cat, paths, dt.datetime(2024, 1, 30))  # incremental: the window's days
    assert all(0 < a < b / 5 for a, b in zip(window, whole))


def test_main_compacts_and_exports(spark, scratch):
    fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    args = ["--sources", cat.root, "--target", scratch, "--floor-date", "2024-01-02", "--floor-time", "2024-01-02T07:30:00",
            "--price-floor", "2024-01-02", "--export-root", scratch + "/export", "--target-days", "3"]
    assert R.main([*args, "--as-of", "2024-01-30T02:00:00+02:00"]) == 0
    assert R.main([*args, "--as-of", "2024-01-31T00:00:00"]) == 0
    assert R.main([*args, "--as-of", "2024-01-31T01:00:00", "--select", "transactions_attributed",
                   "--export-start", "2024-01-10", "--export-end", "2024-01-12"]) == 0
    from codetrail.operators import export as X

    log = {(r.source_table, r.created_at.isoformat()): r for r in X.runs(spark, scratch + "/export/_runs").collect()}
    assert len(log) == 5
    first = log["transactions_attributed", "2024-01-30T00:00:00"]
    assert first.full_refresh and first.time_start is None
    assert not log["transactions_attributed", "2024-01-31T00:00:00"].full_refresh
    table = spark.read.parquet(scratch + "/transactions_attributed")
    window = "block_time >= '2024-01-10' and block_time < '2024-01-12'"
    assert log["transactions_attributed", "2024-01-31T01:00:00"].rows_synced == table.where(window).count()
    # the compaction after the writes left few files in each partition
    from codetrail.operators import upsert

    assert max(r.files for r in upsert.file_counts(spark, scratch + "/transactions_attributed", "block_date").collect()) <= 4


def test_main_runs_end_to_end(spark, scratch):
    fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    code = R.main(["--sources", cat.root, "--target", scratch, "--as-of", "2024-01-31T00:00:00",
                   "--select", "+buildercode_daily_metric", "--test"])
    assert code == 0


def test_main_with_floors_and_replace_days(spark, scratch):
    from codetrail import schemas

    fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    args = ["--sources", cat.root, "--target", scratch, "--as-of", "2024-01-31T00:00:00",
            "--floor-date", "2024-01-02", "--floor-time", "2024-01-02T07:30:00", "--price-floor", "2024-01-02"]
    assert R.main(args) == 0
    assert R.main(args + ["--replace-days", "--select", "buildercode_daily_metric", "--test"]) == 0
    paths = models.ModelPaths.under(scratch)
    got = spark.read.schema(schemas.DAILY_METRIC).parquet(paths.daily_metric)
    want = Q.q_daily_metrics(spark, SF_SMALL)
    assert got.count() == want.count() > 0
