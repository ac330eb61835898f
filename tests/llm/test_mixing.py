import hashlib
import re

import pytest
from pyspark.sql import functions as F, types as T

from codetrail.llm import mixing as M

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("size", T.StringType()), T.StructField("rank", T.IntegerType())])


def brute(rows, weights=(5, 2, 1), epochs=3, seed=42):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total, sources = {}, sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    for (_, _, s), n in zip(rows, size):
        total[s] = total.get(s, 0) + n
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    capped = set()
    while True:
        free = [s for s in sources if s not in capped]
        if not free:
            break
        level = (sum(total.values()) - sum(epochs * total[s] for s in capped)) / sum(w[s] for s in free)
        more = {s for s in free if level * w[s] > epochs * total[s]}
        if not more:
            break
        capped |= more
    target = {s: min(epochs * total[s], level * w[s]) for s in sources}
    out, left = [], {}
    for s in sources:
        budget = int(target[s] + 0.5)
        e = budget // total[s] if total[s] else 0
        left[s] = (e, budget - e * total[s])
    order = sorted(range(len(rows)), key=lambda k: (hashlib.md5(f"{seed}|{'null' if rows[k][0] is None else rows[k][0]}".encode()).hexdigest(), rows[k][0] is None, rows[k][0] or 0))
    at = dict.fromkeys(sources, 0)
    for k in order:
        i, _, s = rows[k]
        e, r = left[s]
        out.append((i, size[k], total[s], float(target[s]), e * size[k] + max(0, min(size[k], r - at[s]))))
        at[s] += size[k]
    return sorted(out, key=str)


def check(spark, rows, **params):
    df = spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], SCHEMA).repartition(3)
    got = M.mix(df, **params)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    want = brute(rows)
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(g[0], g[1], g[2], g[4]) for g in want]
    assert all(a[3] == pytest.approx(b[3], rel=1e-12) for a, b in zip(got, want))
    return df, got


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_equals_brute_force(spark, bucket_rows):
    rows = [(i, "w " * (i * 7 % 23), ["hot", "b", "ü", None, "tiny"][0 if i % 3 else i % 5]) for i in range(300)]
    rows += [(400, None, "b"), (401, "", None), (402, "a\tb\x0bc\x0cd e", "tiny"), (None, "n o", "b"), (403, "z " * 60_000, "big"), (404, "same", "b"), (404, "same", "b")]
    df, got = check(spark, rows, bucket_rows=bucket_rows)
    assert got == sorted((tuple(r) for r in M.mix(df.repartition(5), bucket_rows=bucket_rows).collect()), key=str)
    assert all(g[4] <= 3 * g[1] for g in got)
    docs = M.mix_documents(df, bucket_rows=bucket_rows)
    assert docs.columns == ["doc_id", "text", "source", "rank", "size", "source_size", "target", "taken"]
    assert sorted((r.taken for r in docs.collect())) == sorted(g[4] for g in got if g[4])


def test_every_source_meets_its_rounded_target(spark):
    rows = [(i, "w " * (1 + i % 40), f"s{(i % 17) ** 2 % 11}") for i in range(2000)]
    df, _ = check(spark, rows, bucket_rows=100)
    sums = M.mix(df.withColumn("source", F.col("source"))).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target * round(r.t / r.target)) < 1.01 * round(r.t / r.target) for r in sums)


def test_ranks_of_many_sources(spark):
    df = spark.createDataFrame([(f"s{i:05d}", False, 10) for i in range(3000)] + [("", True, 10), ("", False, 1)],
                               "__mix_source string, __mix_null boolean, source_size long").repartition(5)
    got = {(r[0], r[1]): r.rank for r in M._ranks(df).collect()}
    assert got[("", False)] == 0 and got[("", True)] == 3001 and all(got[(f"s{i:05d}", False)] == i + 1 for i in range(3000))


def test_empty_and_wordless_tables(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, None, "a", "", 1), (2, " ", None, "", 1)], SCHEMA)
    assert sorted(tuple(r) for r in M.mix(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mix_documents(df).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "a", "", 1)], SCHEMA)
    plan = M.mix(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
