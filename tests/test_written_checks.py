"""Quality rules inside the write equal the full pass, and do not read untouched partitions."""

import datetime as dt

from pyspark.sql import functions as F

from checks import fixtures
from checks import params as P
from codetrail.operators import quality as QL, upsert as U
from codetrail.plans import models, run as R

from .conftest import SF_SMALL

RULES = QL.ModelRules("m", not_null=["k", "v"], unique=["k"], unique_combinations=[["k"], ["k", "v"]])


def as_set(df):
    return {(r.rule, r.column, r.failing_rows) for r in df.collect() if r.rule != "rows"}


def table(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.col("id").alias("v"), (F.col("id") / 100).cast("int").alias("part"))


def test_counts_of_the_write_equal_the_full_pass(spark, scratch):
    path = scratch + "/t"
    U.write_table(table(spark, 0, 1000), path, "part")
    batch = table(spark, 850, 1100).withColumn("v", F.when(F.col("k") % 10 != 0, F.col("v")))
    batch = batch.unionByName(batch.where("k % 50 = 1"))
    batch, seen = QL.observed(batch, RULES)
    done = U.delete_insert(spark, batch, path, "k", "part")
    stored = spark.read.schema(batch.schema).parquet(path)
    scope = U.in_partitions(["part"], [(v,) for v in done.touched_partitions])
    assert done.touched_partitions == [8, 9, 10]
    got = QL.observed_summary(stored, RULES, seen, scope)
    assert as_set(got) == as_set(RULES.run(stored))
    assert got.where("rule = 'rows'").first().failing_rows == 255
    assert "PartitionFilters: [" in got._jdf.queryExecution().executedPlan().toString()
    assert {r.rule for r in QL.failing(got).collect()} == {"not_null", "unique", "unique_combination_of_columns"}


def test_empty_batch_and_no_rules(spark, scratch):
    path = scratch + "/t"
    U.write_table(table(spark, 0, 10), path, "part")
    batch, seen = QL.observed(table(spark, 0, 0), QL.ModelRules("m", not_null=["k"]))
    done = U.delete_insert(spark, batch, path, "k", "part")
    rows = QL.observed_summary(spark.read.parquet(path), QL.ModelRules("m", not_null=["k"]), seen,
                               U.in_partitions(["part"], [(v,) for v in done.touched_partitions]), done.rows).collect()
    assert [(r.rule, r.failing_rows) for r in rows] == [("rows", 0), ("not_null", 0)]


def test_the_job_tests_what_it_wrote(spark, scratch):
    fixtures.materialize(spark, SF_SMALL)
    cat, paths = fixtures.fixture_catalog(spark, SF_SMALL), models.ModelPaths.under(scratch)
    for as_of in (None, dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 31)):
        results = R.run(spark, cat, paths, R.ORDER, as_of, floors=P.FLOORS, observe=True)
        assert R.test_written(spark, paths, results) == []
    for name in ("transactions_attributed", "transfers_attributed"):
        seen = results[name].observed.get
        assert seen["rows"] == results[name].rows > 0 and not sum(v for k, v in seen.items() if k != "rows")
