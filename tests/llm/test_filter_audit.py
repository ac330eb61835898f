"""op12: masks and folds against a plain walk over all orders; nulls, ties, empty tables, clashing columns."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from codetrail.llm import filter_audit as A

SCHEMA = "doc_id long, text string, lang string, mask int, part string, good int, digest string"
LABELS = "doc_id long, quality int, toxic int"
WORDS = " ".join(f"w{i}" for i in range(120))


def fails(i, text, first):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > first.get(text, i)}


def plain(docs, labels):
    first, marks = {}, {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, q, t in labels:
        if i is not None:
            a = marks.setdefault(i, [False, False])
            a[0] |= q == 1
            a[1] |= t == 1
    out = {}
    for part in {d[2] or "" for d in docs}:
        mine = [(fails(i, t or "", first), marks.get(i, [False, False])) for i, t, p in docs if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for o in map("".join, permutations("ABCDE")):
            alive = [True] * len(mine)
            for step, f in enumerate(o, 1):
                row = [0] * 6
                for k, (bad, (good, toxic)) in enumerate(mine):
                    gone = alive[k] and bad[f]
                    row[1] += gone
                    row[2] += bad[f] and not alive[k]
                    row[3] += bad[f] and sum(bad.values()) == 1
                    row[4] += gone and good
                    row[5] += gone and toxic
                    alive[k] &= not bad[f]
                row[0] = sum(alive)
                out[part, o, step] = (*row, f)
                shapley[f] += row[1]
        for key, row in out.items():
            if key[0] == part:
                out[key] = (*row[:6], shapley[row[6]])
    return out


DOCS = [(1, WORDS, "en"), (2, WORDS, "en"), (2, WORDS, "en"), (3, None, None), (4, "", ""), (5, "AAAA BBB", "en"), (6, "a # b", "de"),
        (7, "same " * 400, "de"), (None, WORDS, "en"), (None, None, None), (8, "É x\x0by " * 30, "fr"), (9, "Word " * 50_000, "fr"), (10, "*" * 10, "fr")]
MARKS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, 1, 1), (9, None, 1), (99, 1, 1), (None, 1, 1)]


def run(spark, docs, labels=MARKS):
    d = spark.createDataFrame([(*x, 7, "p", 1, "d") for x in docs], SCHEMA)
    got = A.audit(d, spark.createDataFrame(labels, LABELS))
    rows = [r.asDict() for r in got.collect()]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in A.MEASURES) + (r["shapley"],) for r in rows}, rows


def test_all_orders_match_a_plain_walk(spark):
    got, rows = run(spark, DOCS)
    assert got == plain(DOCS, MARKS)
    assert len(rows) == 600 * 4
    assert all(r["filter"] == r["filter_order"][r["step"] - 1] for r in rows)


def test_order_of_rows_and_partitions_do_not_matter(spark):
    d = spark.createDataFrame([(*x, 7, "p", 1, "d") for x in DOCS], SCHEMA)
    labels = spark.createDataFrame(MARKS, LABELS)
    a = A.audit(d.repartition(7, "text"), labels).collect()
    b = A.audit(d.coalesce(1), labels).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_empty_tables(spark):
    assert run(spark, [])[1] == []
    got, rows = run(spark, DOCS, [])
    assert got == plain(DOCS, []) and not any(r["good_lost"] for r in rows)


def test_no_python_and_no_cross_join_in_the_plan(spark):
    d = spark.createDataFrame([(*x, 7, "p", 1, "d") for x in DOCS], SCHEMA)
    plan = A.audit(d, spark.createDataFrame(MARKS, LABELS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("mask", [0, 1, 16, 31, 0b01010])
def test_one_cell_folds_to_its_removals(spark, mask):
    steps = spark.range(1).select(A.folded(F.lit(mask), F.lit(3), F.lit(2), F.lit(1)).alias("s")).first()["s"]
    assert len(steps) == 600
    for k, o in enumerate(permutations(range(5))):
        hit = next((i for i, f in enumerate(o) if mask >> f & 1), None)
        for i in range(5):
            s = steps[5 * k + i]
            assert (s["removed"], s["good_lost"], s["toxic_lost"]) == ((3, 2, 1) if i == hit else (0, 0, 0))
            assert s["kept"] == (3 if hit is None or i < hit else 0)
