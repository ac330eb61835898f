import re

import pytest
from pyspark.sql import functions as F, types as T

from codetrail.llm import licenses as L
from codetrail.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("family", T.StringType()),
                       T.StructField("row", T.IntegerType()), T.StructField("gram", T.StringType())])
COLUMNS = ["doc_id", "n_paragraphs", "n_licensed", "families", "family", "probability", "paragraph"]


@pytest.fixture(scope="module")
def model(spark):
    return L.train(table(spark, SF, "documents"))


def test_grams_equal_the_plain_form(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "a", "", "  ", "a a a", "one, two", "É x-y"] + [t for _, _, t, _ in L.notices()]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.grams(F.col("t")).alias("g"))
    for r in df.collect():
        assert sorted(r.g) == L.plain_grams(r.t)


@pytest.mark.parametrize("containment", [0.5, 0.6, 0.9])
def test_anchors_lose_nothing(containment):
    words = set(L.anchors(containment))
    for *_, gs in L.notices():
        free = [g for g in gs if not words & set(g.split())]
        assert len(free) < containment * len(gs)


def test_held_out_variations(spark, model):
    held = [(k, t, c) for k, (t, c, h) in enumerate(L.variations()) if h]
    df = spark.createDataFrame(held, "k long, text string, c string")
    got = {r.k: r.family for r in L.classify(df, ["k"], model).collect()}
    right = sum(got.get(k, L.UNKNOWN) == c for k, _, c in held)
    assert right / len(held) > 0.9, (right, len(held))
    # a wrong family is worse than none
    assert sum(got.get(k, c) not in (c,) for k, _, c in held if c != L.UNKNOWN) == 0


def test_scores_equal_brute_force(spark, model):
    import math

    weights = {r.gram: r.w for r in model.weights.collect()}
    rows = [(0, "Released under the MIT License."), (1, "Some words. Licensed under CC BY-NC 4.0. And more."), (2, "All rights reserved."),
            (3, "You need a license to drive"), (4, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r.k: r for r in L.classify(spark.createDataFrame(rows, "k long, text string"), ["k"], model).collect()}
    for k, t in rows:
        gs = L.plain_grams(t)
        z = [b + sum(weights[g][i] for g in gs if g in weights) for i, b in enumerate(model.bias)]
        e = [math.exp((x - max(z)) / model.temperature) for x in z]
        c, p = model.classes[e.index(max(e))], max(e) / sum(e)
        share = max((len(set(gs) & set(n)) / len(n) for _, f, _, n in L.notices() if f == c), default=0)
        if c != L.UNKNOWN and p >= L.THRESHOLD and share >= L.CONTAINMENT:
            assert (got[k].family, pytest.approx(got[k].probability), got[k].contained) == (c, p, share)
        else:
            assert k not in got
    assert {k: r.family for k, r in got.items()} == {0: "MIT", 1: "CC-BY-NC", 2: "Proprietary", 4: "GPL"}


PLANTED = {"This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
           "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "All rights reserved.": "Proprietary"}


def test_finds_the_license_lines_of_the_documents(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    assert len(got) == docs.count()
    for d in docs.collect():
        r = got[d.doc_id]
        assert r.n_paragraphs == len([x for x in d.text.split("\n") if x.strip()])
        want = sorted({f for line, f in PLANTED.items() if line in d.text.split("\n")})
        assert r.families == ",".join(want) or (set(want) <= set(r.families.split(",")) and re.search("(?i)licen|rights", d.text)), (d.doc_id, want, r.families)


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, "x\nReleased under the MIT License."), (4, "x\nReleased under the MIT License."), (None, "All rights reserved."),
            (5, "word " * 60_000 + "Licensed under the Apache License, Version 2.0"), (6, "\n".join(["Released under the MIT License."] * 500)),
            (7, "no licence here"), (8, "Licensed under CC BY-NC 4.0.\nAll rights reserved.")]
    out = L.scan(spark.createDataFrame([(i, t, "f", 1, "g") for i, t in rows], SCHEMA).repartition(3))
    assert out.columns == COLUMNS
    got = sorted(((r.doc_id, r.n_paragraphs, r.n_licensed, r.families, r.paragraph) for r in out.collect()), key=str)
    want = [(1, 0, 0, "", None), (2, 0, 0, "", None), (3, 0, 0, "", None), (4, 2, 1, "MIT", 1), (4, 2, 1, "MIT", 1), (None, 1, 1, "Proprietary", 0),
            (5, 1, 1, "Apache-2.0", 0), (6, 500, 500, "MIT", 0), (7, 1, 0, "", None)]
    assert [g for g in got if g[0] != 8] == sorted(want, key=str)
    assert [g[:4] for g in got if g[0] == 8] == [(8, 2, 2, "CC-BY-NC,Proprietary")]
    assert L.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "All rights reserved.", "f", 1, "g")], SCHEMA)
    assert not re.search("Python|Pandas|Arrow", L.scan(df)._jdf.queryExecution().toString())


def test_wrapped_notices(spark):
    import textwrap

    long = [(f, t) for _, f, t, _ in L.notices() if len(t) > 90]
    rows, want = [], {}
    for width in (30, 50, 72):
        for lead in ("", "# "):
            for f, t in long:
                lines = [lead + x for x in textwrap.wrap(t, width)]
                if len(lines) > 1:
                    k = len(rows)
                    rows.append((k, "\n".join(["Some words about the weather.", "", *lines, lead.strip(), "The end of the matter."])))
                    want[k] = f
    gpl, mit = (textwrap.wrap(next(t for f, t in long if f == x), 60) for x in ("GPL", "MIT"))
    rows += [(1000, "\n".join([*gpl, "", *mit])), (1001, "\n".join(["Words before it stand here.", *gpl, "Released under the MIT License.", "and more"])),
             (1002, "\n".join(["Released under the MIT License.", "It may be used by everybody.", "x"])), (1003, "\n".join([*mit, *mit])),
             (1004, "\n".join(["This program is free software: " + gpl[0], *gpl[1:], "either version 3 of the License"]))]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame([(i, t, "f", 1, "g") for i, t in rows], SCHEMA).repartition(3)).collect()}
    assert {k: got[k].families for k in want} == want
    assert all(got[k].n_licensed == 1 and got[k].paragraph == 2 for k in want), [(rows[k], got[k]) for k in want if got[k].n_licensed != 1 or got[k].paragraph != 2]
    assert [(got[k].n_licensed, got[k].families) for k in range(1000, 1005)] == [(2, "GPL,MIT"), (2, "GPL,MIT"), (1, "MIT"), (2, "MIT"), (1, "GPL")]
