import zlib

import numpy as np
from pyspark.sql import types as T

from codetrail.llm import common, quality as Q

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()), T.StructField("y", T.IntegerType())])


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)


def test_tokens():
    b, n = Q.tokens(*flat(["The cat!! sat, the cat", "", " \n", "a a a. a", "é|é", "x"]))
    assert n.tolist() == [7, 0, 0, 5, 3, 1]
    again = int(Q.REPEATED >> np.uint64(49))
    assert (b[7:12] == again).tolist() == [False, True, True, False, True]
    assert b[1] == b[6] and b[0] != b[5]


def test_contexts_equal_a_plain_sum():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "b", "c!", "dd", "e,"], int(rng.integers(0, 30)))) for _ in range(20)]
    bucket, counts = Q.tokens(*flat(texts))
    index = Q.index_vectors()
    got, want = np.zeros((Q.BUCKETS, Q.DIMS), np.int32), np.zeros((Q.BUCKETS, Q.DIMS), np.int32)
    Q.add_contexts(got, bucket, counts, index)
    at = 0
    for n in counts:
        t = bucket[at:at + n]
        for i in range(n):
            for j in range(max(0, i - Q.WINDOW), min(n, i + Q.WINDOW + 1)):
                if j != i:
                    for place, sign in zip(index[0][t[j]], index[1][t[j]]):
                        want[t[i], place] += sign
        at += n
    assert (got == want).all()


def test_word_vectors_do_not_depend_on_partitions(spark):
    docs = common.table(spark, SF, "documents").limit(60)
    a, b = Q.word_vectors(docs.repartition(1)), Q.word_vectors(docs.repartition(5))
    assert (a == b).all() and a.any()


def test_pooled_is_the_mean():
    vectors = np.random.default_rng(1).normal(size=(Q.BUCKETS, Q.DIMS)).astype(np.float32)
    raw, offs = flat(["a b c", "", "d " * 400_000, "e"])
    x = Q.pooled(raw, offs, vectors)
    bucket, _ = Q.tokens(*flat(["a b c"]))
    assert np.allclose(x[0, :Q.DIMS], vectors[bucket].mean(axis=0), atol=1e-6) and x[0, -1] == np.float32(np.log1p(3) / 10)
    assert not x[1].any()


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 5))
    p = 1 / (1 + np.exp(-3 * (x[:, 0] * x[:, 1])))
    y = (rng.random(6000) < p).astype(int)
    net = Q.train(x[:4000], y[:4000])
    q = net(x[4000:])
    assert np.mean((q >= 0.5) == (p[4000:] >= 0.5)) > 0.9
    for lo in (0.0, 0.25, 0.5, 0.75):
        m = (q >= lo) & (q < lo + 0.25)
        assert abs(q[m].mean() - y[4000:][m].mean()) < 0.08


def test_held_out_accuracy(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    out = Q.report(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    r = out.toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(r.doc_id, r.held_out))
    assert r.score.between(0, 1).all() and ((r.score >= 0.5).astype(int) == r.predicted).all()
    h = r.merge(labels.toPandas(), on="doc_id")
    h = h[h.held_out & h.quality.notna()]
    assert (h.predicted == h.quality).mean() > 0.93


def test_cases(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.report(spark.createDataFrame([], SCHEMA), labels).count() == 0
    rows = [(1, None), (2, ""), (None, "words here"), (3, "z " * 100_000), (3, "z " * 100_000)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    assert [r.score for r in Q.report(docs, labels).collect()] == [0.5] * 5
    odd = spark.createDataFrame([(None, 1, 1), (1, None, 1), (2, 1, 0), (3, 0, 0), (2, 0, 0), (5, 1, 1)], labels.schema)
    assert Q.report(docs, odd).count() == 5
