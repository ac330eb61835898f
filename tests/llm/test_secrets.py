import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from codetrail.llm import secrets as S
from codetrail.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("__x", T.IntegerType())])
LETTERS = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
KEY = "|".join([LETTERS("password"), LETTERS("passwd"), LETTERS("secret"), LETTERS("token"), LETTERS("api") + "_?" + LETTERS("key")])
BRUTE = {"assign": (f"({KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8),
         "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 32)}


def brute(text):
    out = [(m.start(), k, n, m.end()) for k, (n, (p, ok)) in enumerate(BRUTE.items()) for m in re.finditer(p, text or "") if ok(m)]
    return [f"{n}:{s}:{e}" for s, _, n, e in sorted(out)]


def check(rows, got):
    assert len(got) == len(rows)
    want = sorted(((i, *[sum(x.startswith(k + ":") for x in b) for k in BRUTE], hashlib.sha256(",".join(b).encode()).hexdigest()) for i, t in rows for b in [brute(t)]), key=str)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    for r in got:
        base = [x for x in r.spans.split(",") if x and not x.startswith("random")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_base_spans_of_the_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = S.report(docs)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    check(rows, out.collect())


def test_base_spans_of_hard_texts(spark):
    rng = np.random.default_rng(2)
    bits = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "abcdefgh", "short", "AKIA", "ABCDEFGH01234567", "0123456789abcdef", "é", "\n", "x.y-z/1", "ſecret", "toKen"]
    rows = [(i, "".join(rng.choice(bits, int(rng.integers(0, 30))))) for i in range(400)]
    rows += [(500, None), (501, ""), (None, "token=12345678"), (502, "secret: token: abcdefghijkl"), (503, "ééé AKIA" + "A" * 12), (503, "ééé AKIA" + "A" * 12),
             (504, "a" * 31), (505, "a" * 32), (506, "f0" * 100_000 + " password = 'abcdefghij'"), (507, "token token=abc password=longvalue1")]
    check(rows, S.report(spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA).repartition(3)).collect())


@pytest.fixture(scope="module")
def scanner():
    return S.Scanner(open(S.VOCABULARY, "rb").read(), S.MAX_RATIO)


def test_random_strings_are_exposed(scanner):
    rng = np.random.default_rng(4)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    keys = ["".join(rng.choice(alphabet, int(rng.integers(24, 60)))) for _ in range(300)]
    found = sum(scanner.random(k.encode()) for k in keys if re.search("[0-9]", k))
    assert found >= 0.98 * sum(bool(re.search("[0-9]", k)) for k in keys)


@pytest.mark.parametrize("s", ["da39a3ee5e6b4b0d3255bfef95601890afd80709", "123e4567-e89b-12d3-a456-426614174000", "internationalization2024", "some_long_variable_name_v2",
                               "MyClassNameFactory2Builder", "2024-01-02-release-notes-final", "averyveryveryverylongword", "12345678901234567890123"])
def test_digests_and_identifiers_are_not(scanner, s):
    assert not scanner.random(s.encode())


def test_spans_of_random_strings(spark):
    key = "xK9vQ2mZ7pL4tR8wB3nY6cJ1"
    rows = [(1, f"é use {key} here"), (2, f"token={key}"), (3, f"{key}"), (4, "plain prose without anything")]
    got = {r.doc_id: r.spans for r in S.report(spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)).collect()}
    assert got == {1: f"random:6:{6 + len(key)}", 2: f"assign:0:{6 + len(key)}", 3: f"random:0:{len(key)}", 4: ""}


def test_long_runs_cover_every_run():
    rng = np.random.default_rng(6)
    for length in (1, 2, 5, 20, 32):
        inside = rng.random(3000) < 0.93
        places = S.long_runs(inside, length)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(int), [0]])))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= length:
                assert ((places >= a) & (places < b)).any()


def test_empty_table(spark):
    assert S.report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("alphabet,least", [("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.97), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdefghijklmnopqrstuvwxyz", 0.97),
                                            ("abcdefghijklmnopqrstuvwxyz", 0.9), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.9)])
def test_keys_without_digits_are_exposed(scanner, alphabet, least):
    rng = np.random.default_rng(8)
    keys = ["".join(rng.choice(list(alphabet), int(rng.integers(20, 60)))) for _ in range(300)]
    assert sum(scanner.random(k.encode()) for k in keys) >= least * len(keys)


@pytest.mark.parametrize("s", ["qzxkvjwpqhgfzbtrmkqs7", "xqzjvkwpqhgf_zbtrmkqs12"])
def test_letters_that_are_no_words_make_no_identifier(scanner, s):
    assert scanner.random(s.encode())


@pytest.mark.parametrize("s", ["getElementsByClassNameAndId", "callback/integrations/production/webhooks", "Donaudampfschifffahrtsgesellschaft", "--------------------------", "SOME_LONG_CONSTANT_NAME"])
def test_words_without_digits_are_not(scanner, s):
    assert not scanner.random(s.encode())


KEYS = ["xK9vQ2mZ7pL4tR8wB3nY", "xK9vQ2mZ_7pL4tR8wB3nY6cJ1", "qZxKvJwPqHgFzBtRmKqS", "aB3x-K9vQ2mZ7pL4tR8wB3nY6cJ1-Zz9q"]


@pytest.mark.parametrize("key", KEYS)
@pytest.mark.parametrize("before,after", [("callback/integrations/production/webhooks/", ""), ("", "/documents/international/administration/settings"),
                                          ("application/configuration/environment=", "/production/documents/international"), ("objects/123e4567-e89b-12d3-a456-426614174000/", "")])
def test_keys_inside_paths_are_exposed(scanner, key, before, after):
    text = (before + key + after).encode()
    found = [text[a:b].decode() for a, _, b in scanner.spans(text, True, True)]
    assert any(key in f for f in found), found


def test_only_the_key_of_a_long_path_is_reported(scanner):
    before = b"documentation/international/administration/integrations/production/webhooks/"
    text = before + KEYS[0].encode() + b"/documentation/international/administration/settings"
    assert scanner.spans(text, True, False) == [(len(before), 3, len(before) + len(KEYS[0]))]


@pytest.mark.parametrize("s", ["objects/123e4567-e89b-12d3-a456-426614174000/documents/international", "commits/DA39A3EE5E6B4B0D3255BFEF95601890AFD80709/documents/production",
                               "2024-01-02-release-notes-final", "archive/2024/01/02/documents/international/settings"])
def test_paths_of_words_and_digests_hide_nothing(scanner, s):
    assert scanner.spans(s.encode(), True, False) == []


def test_keys_beside_a_base_span_are_reported(scanner):
    text = b"0123456789abcdef0123456789abcdef/" + KEYS[0].encode()
    assert scanner.spans(text, True, True) == [(0, 2, 32), (32, 3, 53)]


def test_outside():
    assert S.outside(0, 10, []) == [(0, 10)] and S.outside(0, 10, [(2, 4), (3, 6), (9, 12)]) == [(0, 2), (6, 9)] and S.outside(5, 8, [(0, 9)]) == []
