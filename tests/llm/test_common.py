import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from codetrail.llm import common, decontaminate, toxicity


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    raw, offs = flat(["ab cd ab", "cd", "", "abcd ab"])
    starts, ends, counts = common.spans(raw != 32, offs)
    assert counts.tolist() == [3, 1, 0, 2]
    words = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
    h = common.span_hashes(raw, starts, ends)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert (h[i] == h[j]) == (a == b)


def test_hashes_do_not_collide_on_many_words():
    rng = np.random.default_rng(0)
    words = sorted({"".join(rng.choice(list("abcé"), int(rng.integers(1, 9)))) for _ in range(30_000)})
    raw, offs = flat(words)
    h = common.span_hashes(raw, offs[:-1], offs[1:])
    assert len(np.unique(h)) == len(words)


def test_utf8_of_sliced_columns_with_nulls():
    column = pa.array(["x", "é", None, "", "zz"]).slice(1, 3)
    raw, offs = common.utf8(column)
    assert raw.tobytes() == "é".encode() and offs.tolist() == [0, 2, 2, 2]
    assert list(common.texts(column)) == ["é".encode(), b"", b""]
    assert common.utf8(pa.array([], pa.string()))[1].tolist() == [0]


def test_slices_cover_all_documents():
    offs = np.array([0, 5, 5, 9, 100, 101, 101])
    assert list(common.slices(offs, 10)) == [(0, 3), (3, 4), (4, 6)]


def test_work_arrays_are_not_shipped_with_functions():
    common.span_hashes(np.zeros(10, np.uint8), np.array([0]), np.array([3]))  # fills them here
    for f in (toxicity._score(None, 0), decontaminate._scan([], 0)):
        assert len(cloudpickle.dumps(f)) < 200_000
    block = decontaminate.BenchmarkBlock([(1, "a b c d")], 3)
    assert len(cloudpickle.dumps(block)) < 3_000_000
