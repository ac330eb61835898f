"""Daily metric from mergeable partials: late transactions, retried batches, some days only."""

import datetime as dt

from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail.operators import metrics as M
from codetrail.operators import partials as PT

from .conftest import SF_SMALL


def test_equals_the_daily_metric_in_any_order_and_with_retries(spark, scratch):
    tx, tr, pr = Q.tx_source(spark, SF_SMALL), Q.transfer_source(spark, SF_SMALL), Q.price_source(spark, SF_SMALL)
    odd = F.col("block_number") % 2 == 1
    out = lambda days=None: Q.daily_output(PT.daily_from_parts(spark, scratch, pr, days, P.CHAIN, P.FLOORS))
    assert out().count() == 0                                          # nothing arrived
    PT.add_transfers(spark, tr, scratch, "a", P.CHAIN, P.FLOORS)
    assert out().count() == 0                                          # transfers alone have no (day, code)
    PT.add_transactions(spark, tx.where(odd), scratch, "a", P.FLOORS)
    daily = lambda t: Q.daily_output(M.daily_metrics(Q.tra_full(spark, SF_SMALL, Q.A.attribute_transactions(t, P.FLOORS)),
                                                     Q.A.attribute_transactions(t, P.FLOORS), pr, P.CHAIN, P.FLOORS))
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(out(), daily(tx.where(odd)))
    PT.add_transactions(spark, tx.where(~odd), scratch, "b", P.FLOORS)
    assert PT.add_transactions(spark, tx.where(~odd), scratch, "b", P.FLOORS).rows == 0
    assert PT.add_transfers(spark, tr, scratch, "a", P.CHAIN, P.FLOORS).rows == 0
    whole = daily(tx)
    assert same(out(), whole)
    some = [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
    assert same(out(some), whole.where(F.col("day").isin(some)))


def test_some_days_read_their_directories_only(spark, scratch):
    PT.add_transactions(spark, Q.tx_source(spark, SF_SMALL), scratch, "a", P.FLOORS)
    PT.add_transfers(spark, Q.transfer_source(spark, SF_SMALL), scratch, "a", P.CHAIN, P.FLOORS)
    df = PT.daily_from_parts(spark, scratch, Q.price_source(spark, SF_SMALL), [dt.date(2024, 1, 10)], P.CHAIN, P.FLOORS)
    p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = [x for x in p.splitlines() if x.startswith("PartitionFilters:") and "day" in x]
    assert len(parts) >= 3 and all("2024-01-10" in x for x in parts)
