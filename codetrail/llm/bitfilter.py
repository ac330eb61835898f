"""A bit filter of fixed size over 64-bit values, built by tasks and small enough to broadcast.

It thins a large table before a join: rows outside the filter cannot match and need no shuffle;
rows inside are joined exactly. The filter has ``bits`` / 8 bytes whatever the number of values,
so its size decides how much is shuffled and never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Shared

#: 16 MB.
FILTER_BITS = 1 << 27
SEGMENT_BITS = 1 << 19


def _segments(filter_bits: int):
    """Values -> the non-empty segments of a bit filter of fixed size."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(filter_bits)
            bits = np.sort(bits.astype(np.int64))
            seg = bits // SEGMENT_BITS
            for s in np.unique(seg):
                a, b = np.searchsorted(seg, [s, s + 1])
                held.setdefault(int(s), np.zeros(SEGMENT_BITS, np.uint8))[bits[a:b] % SEGMENT_BITS] = 1
                if len(held) > 64:
                    yield _packed(held)
        if held:
            yield _packed(held)

    return run


def _packed(held: dict) -> pa.RecordBatch:
    out = pa.record_batch({"seg": pa.array(list(held), pa.int64()),
                           "bits": pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())})
    held.clear()
    return out


def _merge(batches):
    """All parts of a segment stand together: OR them."""
    now, total = None, None
    for batch in batches:
        for seg, bits in zip(batch.column("seg").to_pylist(), batch.column("bits").to_pylist()):
            part = np.frombuffer(bits, np.uint8)
            if seg != now:
                if now is not None:
                    yield pa.record_batch({"seg": pa.array([now], pa.int64()), "bits": pa.array([total.tobytes()])})
                now, total = seg, part.copy()
            else:
                total |= part
    if now is not None:
        yield pa.record_batch({"seg": pa.array([now], pa.int64()), "bits": pa.array([total.tobytes()])})


class BitFilter:
    """Fixed-size bit filter over 64-bit values: no false negatives."""

    def __init__(self, parts: dict[int, bytes], bits: int):
        self.parts, self.bits = parts, bits

    def hits(self, fps: np.ndarray) -> np.ndarray:
        at = (fps % np.uint64(self.bits)).astype(np.int64)
        seg, out = at // SEGMENT_BITS, np.zeros(len(fps), bool)
        for s in np.unique(seg):
            if int(s) in self.parts:
                m = seg == s
                low = at[m] % SEGMENT_BITS
                bits = np.frombuffer(self.parts[int(s)], np.uint8)
                out[m] = (bits[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1
        return out


def build(values: DataFrame, bits: int = FILTER_BITS) -> BitFilter:
    """The filter of a one-column table of longs; at most ``bits`` / 8 bytes come to the driver."""
    parts = (values.distinct().mapInArrow(_segments(bits), "seg long, bits binary")
             .repartition("seg").sortWithinPartitions("seg").mapInArrow(_merge, "seg long, bits binary"))
    return BitFilter({r.seg: bytes(r.bits) for r in parts.collect()}, bits)


def _mark(shared, at: int):
    def run(batches):
        for batch in batches:
            hit = shared.value.hits(batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*batch.schema.names, "__hit"])

    return run


def without(docs: DataFrame, id_col: str, gone: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``docs`` whose id is not among the ids of ``gone`` (one column, ``__gone``).

    Only rows that the filter lets through are shuffled with their columns; null ids stay.
    """
    shared = Shared(docs.sparkSession, build(gone.select(F.xxhash64("__gone").alias("h")), bits))
    keyed = docs.withColumn("__h", F.xxhash64(id_col))
    marked = keyed.mapInArrow(_mark(shared, len(docs.columns)), T.StructType([*keyed.schema.fields, T.StructField("__hit", T.BooleanType())]))
    met = marked.where("__hit").join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    return marked.where("not __hit").select(*docs.columns).union(met.select(*docs.columns))
