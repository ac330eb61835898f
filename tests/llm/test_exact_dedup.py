import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from codetrail.llm import exact_dedup as X

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("block", T.StringType()), T.StructField("id", T.IntegerType()),
                       T.StructField("sha", T.StringType())])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(parts)


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i, k))
    out = []
    for norm, g in groups.items():
        g.sort(key=lambda x: (x[0], x[1], x[2] or 0, x[3]))
        for n, x in enumerate(g):
            out.append((x[2], g[0][2], len(g), n == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ROWS = [(1, "a b c"), (2, "abc"), (3, "a  b\tc"), (4, None), (5, ""), (6, " \n"), (7, "é ü"), (8, "éü"), (9, "other"),
        (None, "abc"), (9, "other"), (10, "x" * 200_000), (11, "x " * 200_000), (None, None), (12, " abc"), (3, "a  b\tc")]


@pytest.mark.parametrize("params", [{}, {"block_rows": 3, "owner_rows": 4}])
def test_equals_brute_force(spark, params):
    assert result(X.exact_dedup(frame(spark, ROWS), **params)) == brute(ROWS)


def test_a_hot_text_in_many_blocks(spark):
    rows = [(i, "same text" if i % 3 else f"own {i % 50}") for i in range(3000)]
    assert result(X.exact_dedup(frame(spark, rows, 6), block_rows=100, owner_rows=200)) == brute(rows)


def test_tiny_filter_changes_nothing(spark):
    rows = [(i, f"t{i % 700}") for i in range(1500)]
    small = X.exact_dedup(frame(spark, rows), filter_bits=64)
    assert result(small) == brute(rows)


def test_empty_table(spark):
    df = X.exact_dedup(frame(spark, []))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and df.count() == 0
    assert X.drop_exact_copies(frame(spark, [])).count() == 0


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    docs = frame(spark, ROWS)
    got = X.drop_exact_copies(docs)
    assert got.columns == docs.columns
    want = {(r[0], r[4]) for r in brute(ROWS) if r[3]}
    rows = [(r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest()) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_golomb_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (2 ** 63, 5000 + 2 * n):
        v = np.unique(rng.integers(0, high, n, dtype=np.uint64) << np.uint64(high == 2 ** 63))
        assert (X.golomb_decode(X.golomb_encode(v)) == v).all()
    edge = np.array([0, 2 ** 64 - 1], np.uint64)
    assert (X.golomb_decode(X.golomb_encode(edge)) == edge).all()


def test_golomb_is_smaller_than_the_hashes():
    v = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 60000, dtype=np.uint64))
    assert len(X.golomb_encode(v)) < 0.8 * 8 * len(v)
