"""The pipeline against a plain Python version of its stages on small tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from codetrail.llm import toxicity
from codetrail.llm.common import table

from .test_exact_dedup import brute as brute_exact
from .test_mixing import brute as brute_mix
from .test_simhash import brute_fp, classes

SF = "/root/testdata/sf0.001"


def expected(rows, toxic, items):
    rows = [r for r in rows if r[0] not in toxic]
    keep = {x[0] for x in brute_exact([(i, t) for i, t, _ in rows]) if x[3]}
    rows = [r for r in rows if r[0] in keep]
    fps = [brute_fp(t) for _, t, _ in rows]
    labels, least = classes(fps, 2), {}
    for (i, *_), l in zip(rows, labels):
        least[l] = min(i, least.get(l, i))
    rows = [r for r, l in zip(rows, labels) if least[l] == r[0]]
    short = [(i, t) for i, t, _ in rows]
    bad = {x[0] for x in fast_hits(short, items) if x[1]}
    rows = [r for r in rows if r[0] not in bad]
    return {x[0]: x for x in brute_mix([(i, t, s) for i, t, s in rows]) if x[4]}


def fast_hits(docs, items):
    """Like the brute force of the decontamination test, over sets of windows."""
    from .test_decontaminate import words

    windows = {}
    for k, t in items:
        v = words(t)
        n = min(13, len(v))
        for q in range(len(v) - n + 1) if n else []:
            windows.setdefault(n, set()).add(tuple(v[q:q + n]))
    for i, t in docs:
        w, hit = words(t), set()
        for n, grams in windows.items():
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
        yield i, bool(hit) and 20 * len(hit) >= len(w)


def test_run_equals_the_plain_version(spark):
    docs, labels, bench = (table(spark, SF, t) for t in ("documents", "labels", "benchmark"))
    model = toxicity.fit(docs, labels)
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("__score >= 0.3").select("doc_id").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = expected(rows, toxic, [(r.item_id, r.text) for r in bench.collect()])
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]
    got = {r.doc_id: (r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in out.collect()}
    assert {k: v[4] for k, v in got.items()} == {k: v[4] for k, v in want.items()}
    assert all(v[1:3] == want[k][1:3] and v[3] == pytest.approx(want[k][3]) for k, v in got.items())


def test_stages_take_nulls_repeats_and_clashing_columns(spark, scratch):
    docs = table(spark, SF, "documents")
    for t in ("labels", "benchmark"):
        table(spark, SF, t).write.parquet(f"{scratch}/{t}.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (None, "idiot", "en", "s", 5),
                                 (2, "x " * 50_000, None, "s", None), (2, "x " * 50_000, None, "s", None)], docs.schema)
    docs = docs.limit(30).union(odd).withColumns({"taken": F.lit("t"), "__gone": F.lit(1), "fp": F.lit(2), "at": F.lit(3)})
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, scratch)
        if k < 4:
            assert out.columns == columns, name
        else:
            assert set(out.columns) == set(columns) | {"size", "source_size", "target", "taken"}
        out.write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
    assert docs.count() > 0
    none = table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        none = stage(spark, none, scratch)
    assert none.count() == 0


def test_registered():
    import __spark_entry__ as E

    assert os.path.exists(P.__file__) and E.queries()["pipeline"] is P.run
    assert {q.split("_")[0] for q in E.queries() if q.startswith("op")} == {f"op{n}" for n in range(1, 14)}
