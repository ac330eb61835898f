import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from codetrail.llm import simhash_dedup as S
from codetrail.llm.components import components

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("fp", T.StringType()), T.StructField("id", T.IntegerType())])


def brute_fp(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, d):
    """Naive union of all pairs within d bits."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def groups(keys, labels):
    out = {}
    for k, l in zip(keys, labels):
        out.setdefault(l, set()).add(k)
    return sorted(map(sorted, out.values()))


def near_values(n, seed, clusters=12):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, clusters, dtype=np.uint64)
    out = []
    for _ in range(n):
        v = int(base[rng.integers(clusters)]) << int(rng.integers(2))
        for _ in range(rng.integers(0, 6)):
            v ^= 1 << int(rng.integers(64))
        out.append(v & (2 ** 64 - 1))
    return sorted(set(out) | {0, 1, 2 ** 64 - 1})


@pytest.mark.parametrize("node_rows,d", [(50_000, 2), (5, 2), (3, 1), (50_000, 0)])
def test_trie_links_connect_what_brute_force_connects(spark, node_rows, d):
    fps = near_values(400, node_rows + d)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    roots = dict(map(tuple, components(S.trie_links(df, d, node_rows)).collect()))
    assert groups(signed, [roots.get(x, x) for x in signed]) == groups(signed, classes(fps, d))


def test_fingerprint_equals_brute_force():
    rng = np.random.default_rng(3)
    words = ["The", "é", "ÉX", "run", "A", "b-c", "!", "zz y"]
    for n in (0, 1, 2, 3, 4, 50, 500):
        t = "".join(w + s for w, s in zip(rng.choice(words, n), rng.choice([" ", "\n", "\t ", "\x0b"], n)))
        assert S.fingerprint(t.encode(), 3) == brute_fp(t)
        assert S.fingerprint(b" " + t.encode(), 2) == brute_fp(t, 2)
    assert S.fingerprint(b" \n", 3) == 0


def test_operator_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(None, "a b c d"), (1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (None, "lonely text")]
    for i in range(40):
        words = list(rng.choice(vocab, 400))
        rows.append((100 + 3 * i, " ".join(words)))
        words[int(rng.integers(400))] = "changed"
        rows.append((101 + 3 * i, " ".join(words).upper()))
    rows.append((999, "long " * 150_000))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    got = S.simhash_dedup(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    fps = [brute_fp(t) for _, t in rows]
    labels = classes(fps, 2)
    least = {}
    for (i, _), l in zip(rows, labels):
        if i is not None:
            least[l] = min(i, least.get(l, i))
    want = sorted(((i, f"{f:016x}", least.get(l)) for (i, _), f, l in zip(rows, fps, labels)), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = S.drop_near_copies(df)
    assert kept.columns == df.columns
    stay = sorted(str(i) for (i, _), l in zip(rows, labels) if i is None or least[l] == i)
    assert sorted(str(r.doc_id) for r in kept.collect()) == stay


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.simhash_dedup(df).count() == 0
    assert S.drop_near_copies(df).count() == 0


def test_components_of_a_long_chain(spark):
    n = 60
    edges = [(i + 1, i) for i in range(n)] + [(200, 201), (5, 5), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, n + 1)}, 201: 200}


def test_joins_on_hot_keys_are_split(spark):
    """A fingerprint that a third of all rows share: Spark splits its partition in the last join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "24"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = [(i, "the same text" if i % 3 == 0 else f"own text number {i}") for i in range(12_000)]
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(12)
        out = S.simhash_dedup(df)
        got = {r.doc_id: r.component_id for r in out.collect()}
        assert len(got) == 12_000 and all(got[i] == got[0] for i in range(0, 12_000, 3))
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
