import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from codetrail.llm import langid as L
from codetrail.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("lang_pred", T.StringType()), T.StructField("__x", T.IntegerType())])


def brute_viterbi(scores, penalty):
    """Plain recursion over one document."""
    k = scores.shape[1]
    v, back = scores[0].astype(float).copy(), []
    for s in scores[1:]:
        b = int(v.argmax())
        prev = [b if v[b] - penalty > v[j] else j for j in range(k)]
        v = np.array([max(v[j], v[b] - penalty) for j in range(k)]) + s
        back.append(prev)
    state = int(v.argmax())
    path = [state]
    for prev in reversed(back):
        path.append(prev[path[-1]])
    return path[::-1]


def cost(scores, path, penalty):
    return sum(s[p] for s, p in zip(scores, path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("k", [1, 2, 4, 7])
def test_batched_viterbi_is_optimal(k):
    rng = np.random.default_rng(k)
    counts = rng.integers(0, 12, 40)
    counts[3] = 300
    scores = -rng.integers(0, 9, (counts.sum(), k)).astype(np.float32)
    path, at = L.viterbi(scores, counts, 4.0), 0
    for n in counts:
        s, p = scores[at:at + n], path[at:at + n]
        if n:
            assert cost(s, p, 4.0) == pytest.approx(cost(s, brute_viterbi(s, 4.0), 4.0))
        at += n


def test_words_and_scripts():
    texts = ["Hello, wörld 42", "", "привет мир", "日本 カナ x", "--", "a"]
    raw = "".join(texts).encode()
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    w = L.Words(np.frombuffer(raw, np.uint8), offs)
    assert w.counts.tolist() == [2, 0, 2, 3, 0, 1]
    assert [raw[a:b].decode() for a, b in zip(w.starts, w.ends)] == ["Hello", "wörld", "привет", "мир", "日本", "カナ", "x", "a"]
    assert [L.NAMES[s] for s in w.scripts] == ["Latin", "Latin", "Cyrillic", "Cyrillic", "Han", "Kana", "Latin", "Latin"]


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = L.report(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    r = out.join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(r.doc_id, r.held_out))
    assert r.score.between(0, 1).all() and set(r.lang_pred) <= {"en", "fr", "de", "es", "und"}
    h = r[r.held_out & (r.text.str.len() > 40)]
    assert (h.lang_pred == h.lang).mean() > 0.97


def test_spans_of_mixed_text_scripts_and_cases(spark):
    train = table(spark, SF, "documents").select("doc_id", "text", "lang")
    russian = spark.createDataFrame([(10_000 + i, "это простой русский текст и ещё немного слов " * 20, "ru") for i in range(20)], train.schema)
    model = L.fit(train.union(russian))
    assert model.langs == ["de", "en", "es", "fr", "ru"]
    en = "the and of that with this thing on for are is " * 3
    de = "der die und nicht mit einer schzu keit ungen über für " * 3
    rows = [(1, en + de), (2, None), (3, ""), (4, " 12 -- !"), (5, "«…»"), (6, "это слово"), (7, en + "слово слово слово слово"), (None, en), (1, en + de),
            (8, "the of and " * 40_000), (9, "漢字")]
    df = spark.createDataFrame([(i, t, None, "x", 1) for i, t in rows], SCHEMA).coalesce(1)
    out = L.label(df, model).collect()
    assert len(out) == len(rows)
    assert [s.lang for s in out[0]["__spans"]] == ["en", "de"]
    cut = out[0]["__spans"][1].start
    assert abs(cut - len(en)) < 12
    assert [(r["__lang"], r["__score"]) for r in out[1:5]] == [("und", 0.0)] * 4
    assert out[5]["__lang"] == "ru" and [s.lang for s in out[6]["__spans"]] == ["en", "ru"] and out[7]["__lang"] == "en"
    assert out[9]["__lang"] == "en" and out[10]["__lang"] in model.langs and out[0]["__lang"] == out[8]["__lang"]


def test_empty_tables_and_missing_labels(spark):
    assert L.report(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "the", None, "", 0), (None, None, None, "", 0)], SCHEMA)
    assert sorted((r.lang_pred, r.score) for r in L.report(df).collect()) == [("und", 0.0)] * 2
    one = spark.createDataFrame([(1, "the", "en", "", 0), (None, "x", None, "", 0)], SCHEMA)
    assert {r.lang_pred for r in L.report(one).collect()} == {"en"}
