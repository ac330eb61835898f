"""Character language model: interpolated 4-gram log-probabilities counted over a whole corpus.

Symbols: 0 for anything that ends a word, 1 to 26 for a to z, 27 for a byte of a letter beyond
ASCII (a run of them counts once). The model has 28**4 entries whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

SYMBOLS, ORDER = 28, 4
SIZE = SYMBOLS ** ORDER


def symbol_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[65:91] = t[97:123] = np.arange(1, 27)
    t[0x80:] = 27
    return t


TABLE = symbol_table()


def grams(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Codes of the 4-grams of a run of documents (words are padded by their boundaries)."""
    sym = np.zeros(len(raw) + len(offs) + 2, np.uint8)
    sym[np.arange(len(raw)) + np.repeat(np.arange(1, len(offs)), np.diff(offs))] = TABLE[raw]
    keep = np.ones(len(sym), bool)
    keep[1:] = ~((sym[1:] == sym[:-1]) & ((sym[1:] == 0) | (sym[1:] == 27)))
    sym = np.concatenate([[0, 0], sym[keep]]).astype(np.int32)
    return ((sym[:-3] * SYMBOLS + sym[1:-2]) * SYMBOLS + sym[2:-1]) * SYMBOLS + sym[3:]


def _count(batches):
    total = np.zeros(SIZE, np.int64)
    for batch in batches:
        raw, offs = common.utf8(batch.column(0))
        for i, j in common.slices(offs, common.COUNT_SLICE):
            total += np.bincount(grams(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]), minlength=SIZE)
    code = np.flatnonzero(total)
    yield pa.record_batch({"code": pa.array(code, pa.int64()), "n": pa.array(total[code])})


def counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """4-gram counts over all texts; at most 28**4 rows come to the driver."""
    texts = docs.select(F.col(text_col).cast("string").alias("t"))
    parts = common.for_counting(texts).mapInArrow(_count, "code long, n long")
    with common.small_batches(docs.sparkSession):
        rows = parts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SIZE, np.int64)
    out[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return out


def log_probabilities(n: np.ndarray) -> np.ndarray:
    """log P(symbol | three before), each order interpolated with the next lower one (Witten-Bell)."""
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        c = n.reshape(-1, SYMBOLS ** order).sum(axis=0).reshape(-1, SYMBOLS).astype(float)
        total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        below = np.tile(lower.reshape(-1, SYMBOLS), (len(c) // max(1, lower.size // SYMBOLS), 1))
        lower = (c + (kinds + 1) * below) / (total + kinds + 1)
    return np.log(lower).ravel()
