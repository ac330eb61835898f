"""The daily stream over large batches: only repeated keys are grouped, and days are written as they are dealt."""

import datetime as dt

from pyspark.sql import functions as F

from checks import params as P
from checks import spark_queries as Q
from codetrail import schemas as S
from codetrail.operators import attribution as A
from codetrail.operators import upsert as U
from codetrail.plans import models as MD
from codetrail.streaming import attribution_stream as ST

from .conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in range(3, 7)]


def text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_repeated_keys_alone_are_grouped(spark, monkeypatch):
    rows = [(b"a", 1, "x"), (b"a", 2, "y"), (b"b", 1, "z"), (None, 1, "n"), (None, 3, "m"), (b"c", 5, "w"), (b"c", 5, "v")]
    df = spark.createDataFrame(rows, "hash binary, block_time int, v string")
    want = text(U.dedupe_latest(df, ["hash"], ["block_time"]))
    assert len(want) == 4 and text(U.dedupe_repeated(df, ["hash"], ["block_time"])) == want
    once = df.where("v = 'z' OR v = 'y'")
    assert U.dedupe_repeated(once, ["hash"], ["block_time"]) is once
    grouped = []
    plain = U.dedupe_latest
    monkeypatch.setattr(U, "dedupe_latest", lambda d, *a: grouped.append(d.count()) or plain(d, *a))
    assert text(U.dedupe_repeated(df, ["hash"], ["block_time"])) == want and grouped == [6]
    monkeypatch.setattr(U, "FEW_REPEATED", 1)
    assert text(U.dedupe_repeated(df, ["hash"], ["block_time"])) == want and grouped == [6, 7]


def test_recomputed_days_are_written_as_they_are_dealt(spark, scratch, monkeypatch):
    """A day that loses its transfers is emptied, and transfers are neither kept nor gathered again."""
    paths = MD.ModelPaths.under(scratch)
    tx = Q.tx_source(spark, SF_SMALL).where(F.col("block_date").isin(DAYS))
    MD.run_transactions(spark, tx, paths.transactions_attributed, None, P.FLOORS)
    tr, pr = Q.transfer_source(spark, SF_SMALL).where(F.col("block_date").isin(DAYS)), Q.price_source(spark, SF_SMALL)
    monkeypatch.setattr(U, "balanced", lambda df, by=None: (_ for _ in ()).throw(AssertionError("gathered")) if by else df)
    for some in (tr, tr.where(F.col("block_date") != DAYS[1])):
        ST.recompute_days(spark, DAYS, some, pr, paths, P.CHAIN, P.FLOORS)
        held = spark.read.schema(S.TRANSFERS_ATTRIBUTED).parquet(paths.transfers_attributed)
        want = A.attribute_transfers(A.select_transfers(some, P.CHAIN, P.FLOORS), A.attribution_keys(Q.read_tx_table(spark, paths.transactions_attributed), P.FLOORS))
        assert text(held.select(*want.columns)) == text(want)
