import numpy as np
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer, models, pre_tokenizers

from codetrail.llm import token_count as C
from codetrail.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType()), T.StructField("__x", T.IntegerType())])


def reference(v):
    """The unigram tokenizer of an independent library over the same pieces."""
    t = Tokenizer(models.Unigram(v.pieces, v.unk, v.byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=C.MARK, prepend_scheme="always", split=False)
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def vocabulary():
    return C.load()


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "Hello, world!", "日本語 текст", "\n\n", "x\ty▁z", "naïve café 🙂🙂 ok", "aaaaaaaaaaaaaaaaaaaaaaaa", "𝔘 𝔘𝔘", "a▁▁ b"]


def test_counts_equal_the_tokenizer_on_the_documents(spark, vocabulary):
    count, ref = C.Counter(vocabulary), reference(vocabulary)
    assert count.apart
    for r in table(spark, SF, "documents").limit(250).collect():
        assert count(r.text)[0] == ref(r.text)
    for t in TEXTS:
        assert count(t)[0] == ref(t), t


@pytest.mark.parametrize("text", ["x<s>y", "see<unk>here", "b<0x41>c", "<0x0A> <unk> </s>", "<s>", "</s></s> a", "<0x00><0xFF>"])
def test_text_that_spells_control_pieces_is_plain_text(vocabulary, text):
    plain = [("\U0010FFFF", 0.0), *vocabulary.matching()]
    assert len(plain) == len(vocabulary.pieces) - len(vocabulary.hidden) + 1 and len(vocabulary.hidden) >= 259
    assert C.Counter(vocabulary)(text)[0] == reference(C.Vocabulary(plain, 0, False))(text)


@pytest.mark.parametrize("seed,whole,byte_fallback", [(1, True, False), (2, False, False), (3, True, True), (4, True, False)])
def test_small_vocabularies_with_ties_and_unknown_characters(seed, whole, byte_fallback):
    rng = np.random.default_rng(seed)
    alphabet = list("abc") + [C.MARK]
    pieces = {"<unk>": 0.0}
    if byte_fallback:
        pieces |= {f"<0x{b:02X}>": 0.0 for b in range(256)}
    for _ in range(40):
        p = "".join(rng.choice(alphabet, int(rng.integers(1, 5))))
        if seed == 4 and C.MARK in p.lstrip(C.MARK):
            continue
        pieces[p] = float(-rng.integers(1, 5)) if whole else float(-rng.random() * 4)
    pieces.pop("a", None)
    v = C.Vocabulary(list(pieces.items()), 0, byte_fallback)
    count, ref = C.Counter(v), reference(v)
    for _ in range(600):
        t = "".join(rng.choice(list("abcd "), int(rng.integers(0, 25)), p=[0.3, 0.25, 0.2, 0.1, 0.15]))
        assert count(t)[0] == ref(t), (t, pieces)
        marked = t.replace(" ", C.MARK)
        assert count(t) == (count.run(marked if marked.startswith(C.MARK) else C.MARK + marked) if t else (0, 0))


def brute(v, text):
    """Best score over all segmentations, and whether it is reached by the counted number of pieces."""
    have, low = dict(v.pieces), min(s for _, s in v.pieces) - C.UNKNOWN_BELOW
    best = {0: {0: 0.0}}
    for e in range(1, len(text) + 1):
        best[e] = {}
        for s in range(e):
            p = text[s:e]
            score = have.get(p, low if e - s == 1 else None)
            if score is not None:
                for n, x in best[s].items():
                    best[e][n + 1] = max(best[e].get(n + 1, -1e18), x + score)
    top = max(best[len(text)].values())
    return {n for n, x in best[len(text)].items() if x == top}


def test_counts_belong_to_a_best_path():
    v = C.Vocabulary([("<unk>", 0.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -3.0), ("aba", -6.0), (C.MARK, -1.0)], 0, False)
    count, rng = C.Counter(v), np.random.default_rng(0)
    for _ in range(200):
        t = "".join(rng.choice(list("ab"), int(rng.integers(1, 14))))
        assert count.run(t)[0] in brute(v, t)


def test_operator_and_cases(spark, vocabulary):
    ref = reference(vocabulary)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "a b"), (1, " "), (101, "word " * 100_000), (102, "x" * 60_000)]
    out = C.report(spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA).repartition(3))
    assert out.columns == ["doc_id", "n_chars", "n_tokens", "n_unknown"]
    got = sorted((tuple(r)[:3] for r in out.collect()), key=str)
    assert got == sorted(((i, len(t or ""), ref(t or "")) for i, t in rows), key=str)
    assert C.report(spark.createDataFrame([], SCHEMA)).count() == 0
