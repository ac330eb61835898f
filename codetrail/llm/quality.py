"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every token has a sparse random index vector, and its word vector is the sum of
the index vectors of its neighbours over the whole corpus. Tokens are runs of letters and digits,
runs of symbols, and one sign for a word that repeats the one before; they are hashed into a table
of ``BUCKETS`` rows, so tasks add whole numbers into a table of fixed size and the sum over the
corpus does not depend on the order of tasks.

A document is the mean of its tokens' vectors with the logarithm of its length. A network with one
hidden layer is trained in numpy on at most ``sample_rows`` labelled documents of each class; a
temperature, fitted on a fifth of them held back, calibrates its probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common
from .toxicity import labelled_sample, training_side

BUCKETS, DIMS, NONZERO, WINDOW, SEED = 1 << 15, 48, 2, 2, 7
BLOCK, SALTS = 1024, 32
SAMPLE_ROWS = 10_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
THRESHOLD = 0.5
#: Bytes of text whose token vectors are held at once.
POOL_SLICE = 1 << 20

KIND = np.full(256, 2, np.uint8)  # 0 blank, 1 letter or digit, 2 symbol
KIND[:33] = 0
KIND[48:58] = KIND[65:91] = KIND[97:123] = KIND[0x80:] = 1
REPEATED = np.uint64(0x9E3779B97F4A7C15)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every token, tokens per document)."""
    kind = KIND[raw]
    ws, we, wc = common.spans(kind == 1, offs)
    ss, se, sc = common.spans(kind == 2, offs)
    starts, ends = np.concatenate([ws, ss]), np.concatenate([we, se])
    order = np.argsort(starts, kind="stable")
    starts, ends, word = starts[order], ends[order], (np.arange(len(starts)) < len(ws))[order]
    h, counts = common.span_hashes(raw, starts, ends), wc + sc
    doc = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(h), bool)
    for back in (1, 2):  # the word before may be followed by a symbol
        again[back:] |= (h[back:] == h[:-back]) & word[back:] & word[:-back] & (doc[back:] == doc[:-back])
    h = np.where(again, REPEATED, h)
    return (h >> np.uint64(64 - 15)).astype(np.int64), counts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice(np.array([-1, 1], np.int32), (BUCKETS, NONZERO))


def add_contexts(total: np.ndarray, bucket: np.ndarray, counts: np.ndarray, index) -> None:
    """Adds the index vectors of the neighbours of every token to ``total`` (buckets x dimensions)."""
    places, signs = index
    flat, doc = total.reshape(-1), np.repeat(np.arange(len(counts)), counts)
    for gap in range(1, WINDOW + 1):
        near = np.flatnonzero(doc[gap:] == doc[:-gap]) if len(doc) > gap else np.zeros(0, np.int64)
        a, b = bucket[near], bucket[near + gap]
        for to, of in ((a, b), (b, a)):
            for r in range(NONZERO):
                np.add.at(flat, to * DIMS + places[of, r], signs[of, r])


def _count(batches):
    total, index, seen = np.zeros((BUCKETS, DIMS), np.int32), index_vectors(), False
    for batch in batches:
        raw, offs = common.utf8(batch.column(0))
        for i, j in common.slices(offs):
            add_contexts(total, *tokens(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]), index)
            seen = True
            if np.abs(total).max() > 1 << 30:  # far from overflow
                yield _blocks(total)
                total[:] = 0
    if seen:
        yield _blocks(total)


def _blocks(total: np.ndarray) -> pa.RecordBatch:
    parts = total.reshape(-1, BLOCK * DIMS)
    some = np.flatnonzero(parts.any(axis=1))
    return pa.record_batch({"block": pa.array(some, pa.int64()), "part": pa.array([parts[k].astype(np.int64).tobytes() for k in some], pa.binary())})


def _merge(batches):
    """All parts of a block stand together: add them."""
    now, total = None, None
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("part")):
            part = np.frombuffer(part.as_buffer(), np.int64)
            if block != now:
                if now is not None:
                    yield pa.record_batch({"block": pa.array([now], pa.int64()), "part": pa.array([total.tobytes()])})
                now, total = block, part.copy()
            else:
                total += part
    if now is not None:
        yield pa.record_batch({"block": pa.array([now], pa.int64()), "part": pa.array([total.tobytes()])})


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, from all texts; the table of sums that comes to the driver has a fixed size."""
    sums = common.for_counting(docs.select(F.col(text_col).cast("string").alias("t"))).mapInArrow(_count, "block long, part binary")
    sums = sums.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["block", "salt"], ["block"]):  # many tasks add first, then one for each block
        sums = sums.repartition(*keys).sortWithinPartitions(*keys).select("block", "part").mapInArrow(_merge, "block long, part binary")
    out = np.zeros((BUCKETS // BLOCK, BLOCK * DIMS))
    with common.small_batches(docs.sparkSession):
        for r in sums.toLocalIterator():
            out[r.block] = np.frombuffer(r.part, np.int64)
    out = out.reshape(BUCKETS, DIMS)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(raw: np.ndarray, offs: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(documents x (DIMS + 1)): mean vector of the tokens, logarithm of their number; zeros without tokens."""
    out = np.zeros((len(offs) - 1, DIMS + 1), np.float32)
    for i, j in common.slices(offs, POOL_SLICE):
        bucket, counts = tokens(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
        some = np.flatnonzero(counts)
        if len(some):
            first = (np.cumsum(counts) - counts)[some]
            sums = np.add.reduceat(vectors[bucket], first, axis=0, dtype=np.float64)
            out[i + some, :DIMS] = sums / counts[some, None]
            out[i + some, DIMS] = np.log1p(counts[some]) / 10
    return out


# ---------------------------------------------------------------- network

class Network:
    """Standardised inputs -> tanh layer -> logit / temperature -> probability."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0, shift=0.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature, self.shift = temperature, shift

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = self.logits(x) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the log-loss over four fifths of the rows, temperature on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    x, y = x[order].astype(float), y[order].astype(float)
    cut = max(1, len(y) * 4 // 5)
    mean, scale = x[:cut].mean(axis=0), x[:cut].std(axis=0) + 1e-3
    u = (x - mean) / scale
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rows = rng.permutation(cut)
        for at in range(0, cut, BATCH):
            r = rows[at: at + BATCH]
            h = np.tanh(u[r] @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - y[r]) / len(r)
            back = np.outer(e, p[2]) * (1 - h * h)
            grads = [u[r].T @ back + DECAY * p[0], back.sum(axis=0), h.T @ e + DECAY * p[2], np.array([e.sum()])]
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    rest = slice(cut, None) if len(y) > cut else slice(None)
    z, truth = net.logits(x[rest]), y[rest]
    loss = lambda s: np.logaddexp(0, np.where(truth > 0, -z, z) / s).mean()
    net.temperature = min((0.25 * 1.1 ** i for i in range(40)), key=loss)
    return net


# ---------------------------------------------------------------- operator

class Model:
    """Word vectors and network, as tasks get them."""

    def __init__(self, vectors: np.ndarray, network: Network | None, prior: float):
        self.vectors, self.network, self.prior = vectors, network, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.network(x) if self.network is not None else np.full(len(x), self.prior)


def _pool_sample(shared):
    def run(batches):
        for batch in batches:
            x = pooled(*common.utf8(batch.column(0)), shared.value)
            flat = pa.array(x.reshape(-1))
            yield pa.record_batch({"y": batch.column(1), "x": pa.FixedSizeListArray.from_arrays(flat, DIMS + 1).cast(pa.list_(pa.float32()))})

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", mod: int = 3, held: int = 1,
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Word vectors from all of ``docs``; the network from labelled rows whose crc32(id) mod ``mod`` is not ``held``."""
    vectors = word_vectors(docs, text_col)
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_col, mod, held, sample_rows)
    with common.small_batches(docs.sparkSession):
        rows = sample.mapInArrow(_pool_sample(common.Shared(docs.sparkSession, vectors)), "y int, x array<float>").toArrow()
    y = rows["y"].to_numpy()
    if len(np.unique(y)) < 2:  # nothing to learn from
        return Model(vectors, None, float(share if share is not None else 0.5))
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), DIMS + 1)
    order = np.lexsort((*x.T[::-1], y))  # the network does not depend on the order of rows
    net = train(x[order], y[order])
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    net.shift = float(np.log(share / (1 - share)) - np.log(n1 / n0)) if 0 < share < 1 else 0.0
    return Model(vectors, net, float(share))


def _score(shared, text_at: int):
    def run(batches):
        model = shared.value
        for batch in batches:
            p = model.scores(pooled(*common.utf8(batch.column(text_at)), model.vectors))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score``, the calibrated probability of label 1.

    Null and empty texts have the score of a text without tokens. Repeated rows score alike; an
    empty table gives none; any further columns pass through.
    """
    shared = common.Shared(docs.sparkSession, model)
    return docs.mapInArrow(_score(shared, docs.columns.index(text_col)), T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, mod: int = 3, held: int = 1, **params) -> DataFrame:
    """Per document: ``<id_col>, held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text_col, mod=mod, held=held, **params)
    two = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = score(two, model, "__text").select(
        id_col, (~training_side(F.col(id_col), mod, held)).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"))
    return common.written(out, "quality")
