"""op13: the trie against a plain one; nulls, ties, repeated rows, missing bases, long and equal conversations."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from codetrail.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth int, hi string"


def plain(rows, every=5, heads=9):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def order(x):
        some, turn, role, text = x
        return some, turn, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    own = {c: [x[2:] for x in sorted(t, key=order)] for c, t in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % every if c >= 0 else -(-c % every))
        paths[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, who in members.items():
        under = {k: v for k, v in members.items() if k[:len(node)] == node}
        kids = [k for k in under if len(k) == len(node) + 1]
        leaves = sum(not any(len(o) == len(k) + 1 and o[:len(k)] == k for o in under) for k in under)
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), leaves,
                    sum((len(v) - 1) * len(k[-1][1].encode()) for k, v in under.items() if k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, parts=3, **params):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA).repartition(parts)
    out = P.prefix_trie(df, **params)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)


def table(seed, n=40, vocabulary=3, longest=14):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 200), n):
        for turn in range(rnd.randint(1, longest)):
            rows.append((c, turn, rnd.choice(["user", "bot", None]), rnd.choice(["a", "bé", None, ""][:vocabulary])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,params", [
    (1, {}), (2, {"block": 1, "span": 1}), (3, {"block": 3, "span": 2, "few_ends": 1}), (4, {"block": 5, "every": 2, "heads": 3})])
def test_random_conversations(spark, seed, params):
    rows = table(seed)
    assert run(spark, rows, **params) == plain(rows, params.get("every", 5), params.get("heads", 9))


def test_equal_conversations_share_their_blocks(spark):
    rows = [(5 * c, t, "user", f"line {t}") for c in range(60) for t in range(11)] + [(5 * c, 11, "user", f"end {c % 3}") for c in range(30)]
    assert run(spark, rows, few_ends=4) == plain(rows)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(1, None, "user", "x"), (1, None, None, None), (1, 2, "a", "b"), (1, 2, "a", "b"), (1, 2, "b", ""), (None, 1, "user", "lost"),
            (0, 1, "", None), (0, 0, None, ""), (7, 3, "q", "long " * 40_000), (6, 1, "z", "z"), (-3, 1, "n", "n"), (10**12, 5, "ab", "c"), (10**12 + 1, 5, "a", "bc")]
    assert run(spark, rows) == plain(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    assert run(spark, [(c, 1, "user", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_one_conversation_with_most_rows_is_numbered_over_many_ranges(spark):
    rows = [(5, t // 3, "user", f"t{t % 7}") for t in range(3000)] + [(c, t, "user", "t") for c in (10, 15) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = df.select(F.col("conv_id").alias("c"), "turn", F.md5("text").alias("td"), F.lit(1).cast("long").alias("bytes"))
    got = P.numbered(turns).where("c = 5").select("pos").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 3001))
    longest = [r for r in run(spark, rows, span=16) if r[0] == 5]
    assert len(longest) >= 3000 and max(r[1] for r in longest) == 3000


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")]) == []
