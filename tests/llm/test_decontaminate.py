import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from codetrail.llm import decontaminate as D

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("item_id", T.StringType()), T.StructField("__x", T.IntegerType())])
ITEMS = "item_id long, text string, doc_id long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w = words(t)
        hit, names = set(), set()
        for k, text in items:
            v = words(text)
            n = min(window, len(v))
            for q in range(len(v) - n + 1) if n else []:
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[q:q + n]:
                        hit.update(range(p, p + n))
                        names.add("" if k is None else str(k))
        names = sorted(names)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(seed):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(12)] + ["É", "zz9", "The", "it's"]
    make = lambda n: " ".join(rng.choice(vocab, n))
    items = [(k, make(int(rng.integers(3, 30)))) for k in range(12)] + [(3, "The w1"), (50, ""), (51, None), (None, make(9)), (52, "w0"[:0] + "É")]
    items += [(60, items[4][1]), (61, items[4][1] + " " + items[5][1])]
    docs = [(i, make(int(rng.integers(0, 60)))) for i in range(40)]
    for i in range(40, 60):
        t = items[i % 12][1].upper().replace(" ", ", ")
        docs.append((i, make(20) + ". " + t + "\n" + make(int(rng.integers(0, 300)))))
    docs += [(70, None), (71, ""), (72, " ,.; "), (None, items[2][1]), (73, items[2][1]), (73, items[2][1]), (74, "w1 " * 50_000)]
    return docs, items


@pytest.mark.parametrize("window,block_bytes", [(5, 1 << 20), (13, 1 << 20), (4, 100)])
def test_equals_brute_force(spark, window, block_bytes):
    docs, items = tables(window)
    small = [(i, t) for i, t in docs if len(t or "") < 10_000]
    items = [x for x in items if x[0] != 52] if window != 5 else items
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in small], DOCS).repartition(3)
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], ITEMS)
    got = D.report(df, bench, window=window, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute(small, items, window)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = D.remove_contaminated(df, bench, window=window, block_bytes=block_bytes)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x[0]) for x in want if not x[-1])


def test_longest_matches_and_their_places(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e f g z", "", 0), (2, "c d e f g h", "", 0)], DOCS)
    bench = spark.createDataFrame([(9, "q a b c d e f g h", 0)], ITEMS)
    got = {r.doc_id: [tuple(m) for m in r["__matches"]] for r in D.find_matches(docs, bench, window=4).collect()}
    assert got == {1: [("9", 2, 1, 7)], 2: [("9", 0, 3, 6)]}


def test_long_document(spark):
    docs = spark.createDataFrame([(1, "w1 w2 " * 400_000 + "a b c d", "", 0)], DOCS)
    bench = spark.createDataFrame([(1, "a b c d", 0)], ITEMS)
    assert tuple(D.report(docs, bench, window=3).first())[:4] == (1, 800_004, 4, 1)


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    bench = spark.createDataFrame([(1, "a b", 0)], ITEMS)
    assert D.report(none, bench).count() == 0
    r = D.report(docs, spark.createDataFrame([], ITEMS)).first()
    assert tuple(r)[:4] == (1, 2, 0, 0) and not r.contaminated
    assert D.report(docs, bench).first().contaminated


def longest(doc, item, window):
    """Matches of at least ``window`` words that no other match with the item contains, with the first place in the item."""
    size, found = min(window, len(item)), {}
    for p in range(len(doc)):
        for q in range(len(item)):
            n = 0
            while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]:
                n += 1
            if n >= size and n > found.get(p, (0, 0))[0]:
                found[p] = (n, q)
    return [(p, q, n) for p, (n, q) in sorted(found.items()) if found.get(p - 1, (0, 0))[0] != n + 1]


@pytest.mark.parametrize("pairs", [1 << 20, 7])
def test_repeated_words_in_document_and_item(spark, monkeypatch, pairs):
    monkeypatch.setattr(D, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    make = lambda n, v: " ".join(rng.choice(["la", "da", "na"][:v], n))
    items = [(k, make(int(rng.integers(2, 40)), 1 + k % 3)) for k in range(12)]
    docs = [(i, make(int(rng.integers(0, 60)), 1 + i % 3)) for i in range(30)]
    block = D.BenchmarkBlock(items, 4)
    for i, text in docs:
        raw, found = text.encode(), {}
        D._shard(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), block, found)
        got = sorted((m["item_id"], m["doc_word"], m["item_word"], m["n_words"]) for m in (found[0].matches if found else []))
        assert got == sorted((str(k), *m) for k, t in items for m in longest(words(text), words(t), 4)), i
    if pairs > 7:
        df = spark.createDataFrame([(i, t, "", 0) for i, t in docs], DOCS)
        bench = spark.createDataFrame([(k, t, 0) for k, t in items], ITEMS)
        assert sorted((tuple(r) for r in D.report(df, bench, window=4).collect()), key=str) == brute(docs, items, 4)


def test_repeated_words_cost_no_product():
    block, raw, found = D.BenchmarkBlock([(1, "la " * 1000)], 13), ("la " * 100_000).encode(), {}
    assert len(block.repeats(0).size) < 2 * 1000
    D._shard(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), block, found)
    spans = found[0].matches
    assert D._covered(found[0].covered) == 100_000 and len(spans) == 99_001
    assert all(m["n_words"] == 1000 and m["item_word"] == 0 for m in spans)


def test_a_block_is_sent_small():
    import pickle

    rng = np.random.default_rng(5)
    text = " ".join(f"w{i}" for i in rng.integers(0, 3000, 100_000))
    block = D.BenchmarkBlock([(1, text)], 13)
    sent = pickle.dumps(block)
    assert len(sent) < 12 * len(text)
    again = pickle.loads(sent)
    assert (again.low == block.low).all() and (again.pairs == block.pairs).all()
