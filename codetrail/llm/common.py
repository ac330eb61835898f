"""Helpers shared by the operators: written tables, Arrow text access, vectorised words.

Texts are processed as the UTF-8 bytes of an Arrow batch. A batch is cut into runs of whole
documents of about ``SLICE`` bytes, so the temporary arrays of a task stay at a small multiple of
that size; only a document larger than the slice makes a larger one.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step holds.
SLICE = 1 << 19
#: The same where each step adds a whole table of counts.
COUNT_SLICE = 1 << 21
#: Multiplier of the rolling word hash (odd, so it can be inverted modulo 2**64).
MULT = 0x9E3779B97F4A7C15
MULT_INV = pow(MULT, -1, 1 << 64)


#: Bytes of an Arrow batch while an operator writes a table: a task then holds little beside its arrays.
BATCH_BYTES = 8 << 20


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def limit_batches(spark: SparkSession) -> str:
    """Arrow batches of at most ``BATCH_BYTES`` for the session (a smaller setting stays); returns the setting before."""
    before = spark.conf.get(_BATCH)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)
    return before


@contextmanager
def small_batches(spark: SparkSession):
    """Smaller Arrow batches for the actions inside; the caller's setting comes back afterwards."""
    before = limit_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    # imported here: task functions carry this module by value and must not name the package
    from codetrail.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast value whose classes travel by value too: a plain broadcast names them by module."""

    def __init__(self, spark: SparkSession, value):
        self.data, self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), value

    def __getstate__(self):
        return self.data

    def __setstate__(self, data):
        self.data, self.held = data, None

    @property
    def value(self):
        if self.held is None:
            self.held = cloudpickle.loads(self.data.value)
        return self.held


def for_counting(df: DataFrame, per_core: int = 16) -> DataFrame:
    """At most ``per_core`` partitions for each core of the cluster, joined without a shuffle.

    A counting task holds a table of fixed size and sends it once, so what the tasks send together
    is bounded by the cluster and not by the number of input splits. Smaller inputs are unchanged.
    """
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def positional(docs: DataFrame, **roles: str) -> tuple[DataFrame, list[str]]:
    """``docs`` under names by role and place, and those names: no column clashes with an operator's own.

    ``out.select(*names).toDF(*docs.columns)`` gives the names back.
    """
    names = [f"col_{i}" for i in range(len(docs.columns))]
    for role, column in roles.items():
        names[docs.columns.index(column)] = role
    return docs.toDF(*names), names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def texts(column: pa.Array):
    """The texts of a string column as bytes, one by one; nulls are empty."""
    raw, offs = utf8(column)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        yield raw[a:b].tobytes()


def slices(offs: np.ndarray, size: int = SLICE):
    """Ranges of documents whose bytes fit in ``size`` (at least one document each)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes, never across documents: starts, ends, runs per document."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs) - 1, np.int64)
    st, en = inside.copy(), inside.copy()
    st[1:] &= ~inside[:-1]
    en[:-1] &= ~inside[1:]
    first = offs[:-1][offs[:-1] < offs[1:]]
    last = offs[1:][offs[:-1] < offs[1:]] - 1
    st[first] = inside[first]
    en[last] = inside[last]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    bounds = np.searchsorted(starts, offs)
    return starts, ends, np.diff(bounds)


class Powers:
    """Powers of the hash's multiplier and of its inverse, made when needed in each process and never sent along."""

    def __init__(self):
        self.held: list[np.ndarray] = []

    def __reduce__(self):
        return Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.held or len(self.held[0]) < n:
            size = max(n, SLICE + 1)
            self.held = []
            for m in (MULT, MULT_INV):
                p = np.full(size, m, np.uint64)
                p[0] = 1
                self.held.append(np.cumprod(p, dtype=np.uint64))
        return self.held[0][:n], self.held[1][:n]


_powers = Powers()


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (equal bytes, equal hash), independent of its place."""
    n = len(raw)
    if n == 0 or len(starts) == 0:
        return np.zeros(len(starts), np.uint64)
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64, out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h ^ (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))
