import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from codetrail.llm import charlm, common, toxicity as X

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("__id", T.IntegerType())])
CORPUS = ["you are an idiot and a moron", "this is the end of the road", "what a stupid thing to say", "the moon is up and the sun is down",
          "pathetic trash and clowns", "loser in disguise", "a disgusting worthless scum"] * 50


def grams(texts):
    raw = "".join(texts).encode()
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    return charlm.grams(np.frombuffer(raw, np.uint8), offs)


@pytest.fixture(scope="module")
def logp():
    return charlm.log_probabilities(np.bincount(grams(CORPUS), minlength=charlm.SIZE))


def test_probabilities_sum_to_one(logp):
    assert np.allclose(np.exp(logp).reshape(-1, charlm.SYMBOLS).sum(axis=1), 1)


def test_counts_equal_a_plain_count(spark):
    texts = [None, "", "Ab  c!", "éé x", "ab"]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want = {}
    for t in texts:  # every document stands between boundaries
        s = [0]
        for b in (t or "").encode():
            x = int(charlm.TABLE[b])
            if not (x == s[-1] and x in (0, 27)):
                s.append(x)
        s = [0, 0, 0] + s[1:] + ([0] if s[-1] else [])
        for g in zip(s, s[1:], s[2:], s[3:]):
            code = ((g[0] * 28 + g[1]) * 28 + g[2]) * 28 + g[3]
            if g[3] or g[2]:
                want[code] = want.get(code, 0) + 1
    got = charlm.counts(df)
    for code, n in want.items():
        if code // 28 ** 3:  # grams that start inside a word do not depend on the neighbours
            assert got[code] == n
    assert got.sum() >= sum(want.values())


@pytest.mark.parametrize("seen,text", [("1d10t", "idiot"), ("s t u p i d", "stupid"), ("stuuupid", "stupid"), ("i.d.i.o.t", "idiot"),
                                       ("m0r0n", "moron"), ("p@th3t1c", "pathetic"), ("i d 1 0 t", "idiot"), ("$cum", "scum"), ("moon", "moon"), ("end", "end")])
def test_readings(logp, seen, text):
    assert X.decode(seen, logp.tolist()) == text


def brute_decode(span, logp):
    """All readings of a span, scored one by one."""
    units, i, spaced = [], 0, len(span) > 2 and all(c in X.SEPARATORS for c in span[1::2])
    at = [k for k, c in enumerate(span) if c.isalpha()]
    between = [k for k in range(at[0], at[-1]) if not span[k].isalpha() and (not spaced or k % 2 == 0)] if at else []
    # a symbol between letters is dear as itself; without separators, so are those after the last letter then
    dear = between + [k for k in range(at[-1], len(span)) if not span[k].isalpha()] * (not spaced) if between else []
    while i < len(span):
        c = span[i]
        if c.isascii() and c.isalpha():
            n = len(span[i:]) - len(span[i:].lstrip(c))
            units.append([(c * n, 0.0)] + ([] if n == 1 else [(c, X.SHORTEN_TWO)] if n == 2 else [(c * 2, X.SHORTEN), (c, X.SHORTEN)]))
            i += n
            continue
        units.append([("", X.JOIN), (" ", 0.0)] if spaced and i % 2 else [(x, X.SUBSTITUTE) for x in X.LEET[c]] + [(" ", X.INSIDE if i in dear else X.LITERAL)] if c in X.LEET else [(" ", 0.0)])
        i += 1
    best = (math.inf, "")
    for choice in itertools.product(*units):
        cost, s = sum(p for _, p in choice), [0, 0, 0]
        for ch in "".join(t for t, _ in choice) + " ":
            x = 0 if ch == " " else ord(ch) - 96
            if x == 0 and s[-1] == 0:
                continue
            cost -= logp[((s[-3] * 28 + s[-2]) * 28 + s[-1]) * 28 + x]
            s.append(x)
        best = min(best, (cost, "".join(" " if x == 0 else chr(96 + x) for x in s[3:]).strip()))
    return best


def test_viterbi_finds_the_best_of_all_readings(logp):
    rng = np.random.default_rng(1)
    lp = logp.tolist()
    for k in range(150):
        n = int(rng.integers(1, 8))
        s = "".join(rng.choice(list("aidots01$!3"), n))
        if k % 3 == 0:
            s = " ".join(s)
        cost, text = brute_decode(s, lp)
        got = X.decode(s, lp)
        if got != text:  # a tie
            again = [c for c in (cost,) if math.isclose(c, cost)]
            assert again and len(got) == len(text)


def test_suspicious_spans():
    def found(t):
        raw = np.frombuffer(t.lower().encode(), np.uint8)
        return [t.lower().encode()[a:b].decode() for a, b in zip(*X.suspicious(raw, np.array([0, len(raw)])))]

    assert found("an 1d10t said stuuupid things") == ["1d10t", "stuuupid"]
    assert found("what a s t u p i d idea") == ["a s t u p i d"]
    assert found("m.o.r.o.n!") == ["m.o.r.o.n"]
    assert found("plain words, wow!! and 100 more *** it's") == []
    assert found("") == []


def test_held_out_accuracy_and_cases(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = X.fit(docs, labels)
    r = X.report(docs, labels).join(labels, "doc_id").toPandas()
    assert r.score.between(0, 1).all() and ((r.score >= 0.3).astype(int) == r.predicted).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(r.doc_id, r.held_out))
    h = r[r.held_out & r.toxic.notna()]
    right = (h.predicted == h.toxic).mean()
    assert right > 0.93, right
    clean = docs.join(labels.where("toxic = 0 and quality = 1"), "doc_id").orderBy("doc_id").first().text[:400]
    rows = [(1, clean), (2, clean + " 1d10t and m 0 r 0 n, you stuuupid p@th3tic l0ser"), (3, None), (4, ""), (None, clean), (1, clean),
            (5, clean[:60] + " idiot moron stupid pathetic loser"), (6, "a " * 100_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).coalesce(1)
    out = X.score(df, model).collect()
    assert len(out) == len(rows) and [r["__score"] >= 0.3 for r in out] == [False, True, False, False, False, False, True, False]
    assert {x.seen: x.text for x in out[1]["__restored"]}["1d10t"] == "idiot"
    kept = X.drop_toxic(df, labels, sample_rows=10)
    assert kept.columns == df.columns


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([], SCHEMA)
    assert X.report(docs, labels).count() == 0
    some = spark.createDataFrame([(1, "idiot", "", 0), (2, None, "", 0)], SCHEMA)
    assert [r.predicted for r in X.report(some, labels).collect()] == [0, 0]
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (1, 1, 1), (1, 0, 0)], labels.schema)
    assert X.report(some, odd).count() == 2


def restored(logp, text):
    raw = text.lower().encode()
    found = X.Restorer(logp)(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return {seen.decode(): to.decode() for _, _, seen, to in found}


@pytest.mark.parametrize("seen,text", [("m 0 r 0 n", "moron"), ("i d 1 0 t", "idiot"), ("i.d.1.0.t", "idiot"), ("s  t  u  p  i  d", "stupid"), ("m - o - r - o - n", "moron"),
                                       ("i d 1 0 7", "idiot"), ("m * 0 * r * 0 * n", "moron"), ("s* t* u* p* i* d", "stupid"), ("$ c u m", "scum"), ("m ** 0 ** r ** 0 ** n", "moron")])
def test_spaced_words_with_leet_are_decoded(logp, seen, text):
    assert restored(logp, f"look, ({seen})! end")[seen] == text
    assert restored(logp, seen)[seen] == text


def test_chains_stay_in_their_document():
    raw = np.frombuffer(b"m 0 r 0 n1 2 3", np.uint8)
    assert [(a, b) for a, b in zip(*X.suspicious(raw, np.array([0, 9, 14]))) if b - a > 2] == [(0, 9)]
    assert not len(X.suspicious(np.frombuffer(b"1 2 3 4", np.uint8), np.array([0, 7]))[0])


ENDINGS = ["shit hits the fan", "an idiot said shit", "you ass", "what a bit", "the ass and the idiot"] * 100


@pytest.fixture(scope="module")
def more():
    return charlm.log_probabilities(np.bincount(grams(CORPUS + ENDINGS), minlength=charlm.SIZE))


@pytest.mark.parametrize("seen,text", [("idi07", "idiot"), ("1d1075", "idiots"), ("a55", "ass"), ("a$$", "ass"), ("shi+", "shit"), ("5h17", "shit"), ("iddiot", "idiot"),
                                       ("ssttuuppiidd", "stupid"), ("1d1o7", "idiot")])
def test_symbol_endings_and_doubled_letters_are_decoded(more, seen, text):
    lp = charlm.log_probabilities(np.bincount(grams(CORPUS + ENDINGS + ["idiots"] * 1000), minlength=charlm.SIZE))
    assert restored(lp, f"an {seen} there")[seen] == text


def test_plain_punctuation_and_numbers_stay(more):
    assert restored(more, "the end! the moon!! the sun) 100 and 2024, 455 *** end(") == {}


def test_symbols_alone_up_to_the_bound_read_as_themselves(more):
    least, rng = X.least_symbols(more), np.random.default_rng(3)
    assert least >= 1
    for _ in range(100):
        s = "".join(rng.choice(list("0123456789@$!|+("), int(rng.integers(1, int(least) + 1))))
        assert X.decode(s, more.tolist()) == ""


def test_the_sample_is_bounded_when_ids_repeat(spark):
    docs = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, toxic int")
    sample, _ = X.labelled_sample(docs, labels, "doc_id", "text", "toxic", 4, 9, 10)
    assert sorted(r.text for r in sample.collect()) == ["text 0", "text 1", "text 1001"]


PIECES = ["what a worthless thing", "you stupid man", "an idiot", "a loser and a moron", "pathetic and disgusting", "the end of the road is near"] * 200


@pytest.fixture(scope="module")
def pieces():
    return charlm.log_probabilities(np.bincount(grams(CORPUS + ENDINGS + PIECES), minlength=charlm.SIZE))


@pytest.mark.parametrize("seen,word", [("stu pid", "stupid"), ("wor-th-less", "worthless"), ("st.up.id", "stupid"), ("pathe-tic", "pathetic"), ("disgus_ting", "disgusting"),
                                       ("mo ron", "moron"), ("id iot", "idiot"), ("lo ser", "loser"), ("w0rthle55", "worthless"), ("l0ser5", "loser"), ("w0rthl3ss", "worthless"),
                                       ("w0r-thl3ss", "worthless"), ("m.0.r.0.n", "moron"), ("st*up*id", "stupid")])
def test_words_in_pieces_and_leet_are_read(pieces, seen, word):
    for text in (seen, f"you {seen} man", f"look, ({seen})! end"):
        assert any(word[:6] in t.split() or any(w.startswith(word) for w in t.split()) for t in restored(pieces, text).values()), text


def test_plain_text_is_not_joined(pieces):
    for text in PIECES + CORPUS[:7] + ["the end. the road, and the sun - up/down"]:
        assert all(" ".join(t.split()) == " ".join(X.PLAIN.split(s)).strip() for s, t in restored(pieces, text).items()), restored(pieces, text)


def test_cuts_stay_in_their_document(pieces):
    raw = np.frombuffer(b"stu pidstu" + b" pid stu pid", np.uint8)
    whole = X.cuts(raw, np.array([0, 10, 10, len(raw)]), pieces)
    assert all((b <= 10) == (a < 10) for a, b in zip(*whole))
    one = [X.cuts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), pieces) for t in (b"stu pidstu", b" pid stu pid", b"", b"a", b" a ")]
    want = sorted([(int(a), int(b)) for a, b in zip(*one[0])] + [(int(a) + 10, int(b) + 10) for a, b in zip(*one[1])])
    assert sorted((int(a), int(b)) for a, b in zip(*whole)) == want and not sum(len(x[0]) for x in one[2:])


# toxic words of the corpus, spelt in each way of the channel
def spellings(word, rng):
    yield "plain", word
    leet = {"o": "0", "i": "1", "e": "3", "a": "4", "s": "5", "t": "7"}
    k = int(rng.integers(2, len(word) - 1))
    some = [i for i, c in enumerate(word) if c in leet]
    pick = set(rng.permutation(some)[:max(1, len(some) // 2)].tolist())
    digits = "".join(leet[c] if i in pick else c for i, c in enumerate(word))
    yield "leet", digits
    yield "spacing", word[:k] + str(rng.choice(list(" .-_"))) + word[k:]
    yield "letters", str(rng.choice(list(" .-_"))).join(word)
    yield "repetition", word[:k] + word[k] * 3 + word[k:]
    yield "mixed", " ".join(digits)


def test_recall_by_kind_of_spelling(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = X.fit(docs, labels)
    held = docs.join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2")
    clean = [r.text for r in held.where("toxic = 0 and quality = 1").orderBy("doc_id").limit(40).collect()]
    # words of at least one in twenty toxic texts, and of hardly any clean one
    split = docs.join(labels, "doc_id").select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w")).where("length(w) > 4")
    seen = split.groupBy("w").agg(F.sum((F.col("toxic") == 1).cast("int")).alias("bad"), F.sum((F.col("toxic") == 0).cast("int")).alias("good"))
    n = labels.where("toxic = 1").count()
    bad = sorted(r.w for r in seen.where((F.col("bad") * 20 >= n) & (F.col("good") * 50 < F.col("bad"))).collect())
    assert len(bad) >= 5
    rng, rows = np.random.default_rng(5), []
    for i, text in enumerate(clean):
        four = [dict(spellings(w, rng)) for w in rng.choice(bad, 4, replace=False)]  # as many as a toxic text holds at least
        for kind in four[0]:
            rows.append((i, kind, f"{text[:300]} {four[0][kind]}, {four[1][kind]} {text[300:600]} {four[2][kind]} ({four[3][kind]})"))
    rows += [(i, "clean", t) for i, t in enumerate(clean)]
    out = X.score(spark.createDataFrame(rows, "i int, kind string, text string").coalesce(2), model).select("i", "kind", "__score").toPandas()
    found = out[out["__score"] >= 0.3].groupby("kind").i.agg(set).to_dict()
    # of the texts that are found when plainly spelt
    share = {k: len(found.get(k, set()) & found["plain"]) / len(found["plain"]) for k in out.kind.unique()}
    print("plain", len(found["plain"]), "of", len(clean), "by kind", share)
    assert "clean" not in found and len(found["plain"]) > 30
    assert min(v for k, v in share.items() if k != "clean") >= 0.9, share
