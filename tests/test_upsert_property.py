"""delete+insert against a plain-Python model on random tables."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from codetrail.operators import upsert

D0 = dt.date(2024, 1, 1)
row = st.tuples(st.sampled_from("abcdefgh"), st.integers(0, 3), st.integers(0, 99))


def model(target, batch):
    keys = {k for k, _, _ in batch}
    return sorted([r for r in target if r[0] not in keys] + list(batch))


@settings(max_examples=6, deadline=None)
@given(st.lists(row, max_size=12, unique_by=lambda r: r[0]), st.lists(row, min_size=1, max_size=8),
       st.booleans())
def test_delete_insert_matches_model(spark, target, batch, partitioned):
    from codetrail.session import scratch_path

    path = scratch_path(spark, "prop")
    schema = "k string, d date, v int"

    def frame(rows):
        return spark.createDataFrame([(k, D0 + dt.timedelta(days=d), v) for k, d, v in rows], schema)

    part = "d" if partitioned else None
    if target:
        upsert.delete_insert(spark, frame(target), path, ["k"], part)
    upsert.delete_insert(spark, frame(batch), path, ["k"], part)
    got = sorted((r["k"], (r["d"] - D0).days, r["v"]) for r in spark.read.parquet(path).collect())
    assert got == model(target, batch)
