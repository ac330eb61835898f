"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. One pass over the texts: every partition cuts its rows into blocks and computes, per row, a
   64-bit fingerprint and the SHA-256 of the normalised text. Blocks are written to the shared
   folder; that table fixes the row numbers, so later steps can be retried on any executor.
2. Each block sends its sorted distinct fingerprints, Golomb-Rice coded, to the owners of the
   fingerprint ranges. An owner answers each block with a bitmap: bit set if another block has
   the same fingerprint. A text with many copies is sent once by each block, so no owner gets
   more of it than there are blocks.
3. Rows whose bit is set, or whose fingerprint repeats inside their block, are suspects. Only
   their normalised texts are shuffled, grouped by all their bytes and counted; copies are
   combined before the shuffle. Suspects proven alone stay.

Only counts and one fixed-size filter (``filter_bits`` / 8 bytes, whatever the input) pass the
driver. The filter thins the second reading to suspects; what it lets through in error is dropped
by the byte check, so its size affects the amount shuffled and never the result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .bitfilter import FILTER_BITS, BitFilter, build
from .common import Shared, positional, texts, written

#: Characters that normalisation deletes: U+0020 and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"
BLOCK_ROWS = 1 << 16
OWNER_ROWS = 1 << 21


# ---------------------------------------------------------------- Golomb-Rice coding

def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values: count, parameter, unary quotients, then remainders."""
    n = len(values)
    if n == 0:
        return np.array([0, 0, 0], np.uint64).tobytes()
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(values[-1]) / n
    k = max(0, min(63, int(math.log2(max(mean * math.log(2), 1.0)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    unary = np.packbits(unary)
    if k:
        rest = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
        rest = np.packbits(rest.astype(np.uint8).ravel()).tobytes()
    else:
        rest = b""
    return np.array([n, k, len(unary)], np.uint64).tobytes() + unary.tobytes() + rest


def golomb_decode(data: bytes) -> np.ndarray:
    n, k, size = (int(x) for x in np.frombuffer(data, np.uint64, 3))
    if n == 0:
        return np.zeros(0, np.uint64)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, 24)))[:n]
    gaps = (np.diff(ones, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, -1, 24 + size))[: n * k].reshape(n, k)
        gaps += (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


# ---------------------------------------------------------------- tasks

def _texts(column: pa.Array) -> list[bytes]:
    return [t.translate(None, SPACES) for t in texts(column)]


def _owner(fps: np.ndarray, bits: int) -> np.ndarray:
    return (fps >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(fps), np.int64)


def _block_maker(id_type: pa.DataType, rows: int):
    schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(id_type)),
                        ("chars", pa.list_(pa.int64())), ("fp", pa.binary()), ("sha", pa.binary())])

    def run(batches):
        pid, k, held = TaskContext.get().partitionId(), 0, []

        def flush():
            nonlocal k
            ids = pa.concat_arrays([h[0] for h in held])
            chars = pa.concat_arrays([h[1] for h in held])
            n = len(ids)
            edge = pa.array([0, n], pa.int32())
            out = pa.record_batch([
                pa.array([(pid << 24) + k]), pa.array([n], pa.int64()), pa.ListArray.from_arrays(edge, ids),
                pa.ListArray.from_arrays(edge, chars), pa.array([np.concatenate([h[2] for h in held]).tobytes()]),
                pa.array([b"".join(h[3] for h in held)])], schema=schema)
            held.clear()
            k += 1
            return out

        for batch in batches:
            chars = pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64())
            normal = _texts(batch.column(1))
            fps = np.fromiter((xxhash.xxh64_intdigest(t) for t in normal), np.uint64, len(normal))
            sha = [hashlib.sha256(t).digest() for t in normal]
            del normal
            at = 0
            while at < len(fps):
                take = min(len(fps) - at, rows - sum(len(h[0]) for h in held))
                held.append((batch.column(0).slice(at, take), chars.slice(at, take), fps[at: at + take],
                             b"".join(sha[at: at + take])))
                at += take
                if sum(len(h[0]) for h in held) == rows:
                    yield flush()
        if held:
            yield flush()

    return run


def _sender(bits: int):
    def run(batches):
        for batch in batches:
            for block, fp in zip(batch.column("block").to_pylist(), batch.column("fp").to_pylist()):
                fps = np.unique(np.frombuffer(fp, np.uint64))
                owners = _owner(fps, bits)
                cuts = np.flatnonzero(np.diff(owners, prepend=-1))
                parts = np.split(fps, cuts[1:]) if len(cuts) else []
                yield pa.record_batch({
                    "owner": pa.array([int(owners[c]) for c in cuts], pa.int64()),
                    "block": pa.array([block] * len(parts), pa.int64()),
                    "hashes": pa.array([golomb_encode(p) for p in parts], pa.binary())})

    return run


def _answer(batches):
    """Owners: all payloads of one owner stand together in the partition."""
    def reply(owner, blocks, payloads):
        parts = [golomb_decode(p) for p in payloads]
        _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        repeated = (counts > 1)[inverse].astype(np.uint8)
        edges = np.cumsum([len(p) for p in parts])[:-1]
        return pa.record_batch({
            "block": pa.array(blocks, pa.int64()), "owner": pa.array([owner] * len(blocks), pa.int64()),
            "bitmap": pa.array([np.packbits(x).tobytes() for x in np.split(repeated, edges)], pa.binary())})

    now, blocks, payloads = None, [], []
    for batch in batches:
        for owner, block, data in zip(*(batch.column(c).to_pylist() for c in ("owner", "block", "hashes"))):
            if owner != now and blocks:
                yield reply(now, blocks, payloads)
                blocks, payloads = [], []
            now = owner
            blocks.append(block)
            payloads.append(data)
    if blocks:
        yield reply(now, blocks, payloads)


def _row_maker(bits: int, id_type: pa.DataType):
    """Blocks with their answers -> rows marked as suspects or not."""
    def run(batches):
        for batch in batches:
            cols = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                fps = np.frombuffer(cols["fp"][i].as_py(), np.uint64)
                distinct, inverse, counts = np.unique(fps, return_inverse=True, return_counts=True)
                owners, flags = _owner(distinct, bits), counts > 1
                for answer in cols["answers"][i].as_py() or []:
                    a, b = np.searchsorted(owners, [answer["owner"], answer["owner"] + 1])
                    flags[a:b] |= np.unpackbits(np.frombuffer(answer["bitmap"], np.uint8))[: b - a].astype(bool)
                sha, n, block = cols["sha"][i].as_py(), len(fps), cols["block"][i].as_py()
                yield pa.record_batch({
                    "block": pa.array(np.full(n, block)), "pos": pa.array(np.arange(n, dtype=np.int64)),
                    "id": cols["ids"][i].values, "chars": cols["chars"][i].values,
                    "fp": pa.array(fps.view(np.int64)),
                    "sha": pa.array([sha[j * 32: j * 32 + 32] for j in range(n)], pa.binary()),
                    "suspect": pa.array(flags[inverse])})

    return run


def _suspect_texts(shared):
    """Texts -> (fp, sha, normalised bytes, copies) of those in the filter, combined per batch."""
    def run(batches):
        flt = shared.value
        for batch in batches:
            normal = _texts(batch.column(0))
            fps = np.fromiter((xxhash.xxh64_intdigest(t) for t in normal), np.uint64, len(normal))
            copies: dict[bytes, int] = {}
            for i in np.flatnonzero(flt.hits(fps)):
                copies[normal[i]] = copies.get(normal[i], 0) + 1
            yield pa.record_batch({
                "sha": pa.array([hashlib.sha256(t).digest() for t in copies], pa.binary()),
                "bytes": pa.array(list(copies), pa.binary()), "n": pa.array(list(copies.values()), pa.int64())})

    return run


# ---------------------------------------------------------------- operator

class ExactDedup:
    """The decisions on every row of ``docs`` and the filter that holds all suspects."""

    def __init__(self, rows: DataFrame, suspects: BitFilter):
        self.rows, self.suspects = rows, suspects


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS,
           owner_rows: int = OWNER_ROWS, filter_bits: int = FILTER_BITS) -> ExactDedup:
    """Group equal texts of ``docs`` (see :func:`exact_dedup`)."""
    spark = docs.sparkSession
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = two.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    block_schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("chars", T.ArrayType(T.LongType())),
        T.StructField("fp", T.BinaryType()), T.StructField("sha", T.BinaryType())])
    blocks = written(two.mapInArrow(_block_maker(arrow_id, block_rows), block_schema), "dedup-blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / owner_rows)))) if total else 0
    bits = max(bits, min(6, max(0, math.ceil(math.log2(max(1, total / 4096))))))  # a few owners even for small inputs

    sent = blocks.select("block", "fp").mapInArrow(_sender(bits), "owner long, block long, hashes binary")
    answers = (sent.repartition("owner").sortWithinPartitions("owner", "block")
               .mapInArrow(_answer, "block long, owner long, bitmap binary"))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("owner", "bitmap")).alias("answers"))
    row_schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("id", id_type),
        T.StructField("chars", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("sha", T.BinaryType()),
        T.StructField("suspect", T.BooleanType())])
    rows = written(blocks.join(answers, "block", "left").mapInArrow(_row_maker(bits, arrow_id), row_schema), "dedup-rows")

    suspects = rows.where("suspect")
    flt = build(suspects.select("fp"), filter_bits)
    shared = Shared(spark, flt)

    texts = two.select("text").mapInArrow(_suspect_texts(shared), "sha binary, bytes binary, n long")
    equal = (texts.groupBy("sha", "bytes").agg(F.sum("n").alias("n"))
             .groupBy("sha").agg(F.sum("n").alias("verified"), F.count("*").alias("texts")))
    # copies meet block by block first: a hot text has at most one row for each block
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("u"), "id", "block", "pos"))
    local = suspects.groupBy("sha", "block").agg(F.count("*").alias("n"), best.alias("best"))
    groups = local.groupBy("sha").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    groups = groups.join(equal, "sha", "left").select(
        "sha", "best",
        F.when((F.col("texts") == 1) & (F.col("verified") == F.col("n")), F.col("n"))
         .otherwise(F.raise_error(F.lit("exact dedup: byte check and digests disagree"))).alias("group_size"))
    told = local.select("sha", "block").join(groups, "sha")
    grouped = suspects.join(told, ["sha", "block"]).select(
        "id", "chars", "sha", F.col("best.id").alias("keep_id"), "group_size",
        ((F.col("best.block") == F.col("block")) & (F.col("best.pos") == F.col("pos"))).alias("kept"))
    alone = rows.where(~F.col("suspect")).select("id", "chars", "sha", F.col("id").alias("keep_id"),
                                                  F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return ExactDedup(grouped.unionByName(alone), flt)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Which row stays for every row of ``docs``.

    Texts are equal when identical after deleting U+0020 and U+0009 to U+000D; a null text is
    empty. Of equal texts the row with the most code points stays, then the smallest id (null
    ids last); of rows equal in all that, one. Every input row gives one result row, repeated
    rows too; an empty table gives none; other columns, whatever their names, are ignored.

    Returns ``<id_col>, keep_id, group_size, kept, text_sha256``.
    """
    out = decide(docs, id_col, text_col, **params).rows
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                      F.lower(F.hex("sha")).alias("text_sha256"))


def _marker(shared, text_at: int):
    def run(batches):
        flt = shared.value
        for batch in batches:
            column = batch.column(text_at)
            chars = pc.fill_null(pc.utf8_length(column), 0).cast(pa.int64())
            normal = _texts(column)
            fps = np.fromiter((xxhash.xxh64_intdigest(t) for t in normal), np.uint64, len(normal))
            hit = flt.hits(fps)
            sha = [hashlib.sha256(t).digest() if h else None for t, h in zip(normal, hit)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hit), pa.array(sha, pa.binary()), chars],
                names=[*batch.schema.names, "__hit", "__sha", "__chars"])

    return run


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows outside the suspect filter pass through without a shuffle; the others meet the keys
    ``(id, sha, length)`` that go. Repeated rows under one key leave one row.
    """
    plain, names = positional(docs, id=id_col, text=text_col)
    done = decide(plain, "id", "text", **params)
    gone = written(done.rows.where("group_size > 1").groupBy("id", "sha", "chars").agg(F.max("kept").alias("stays"))
                   .where("not stays").select(F.col("id").alias("__k"), F.col("sha").alias("__s"), F.col("chars").alias("__c")),
                   "dedup-gone")
    shared = Shared(docs.sparkSession, done.suspects)
    schema = T.StructType([*plain.schema.fields, T.StructField("__hit", T.BooleanType()),
                           T.StructField("__sha", T.BinaryType()), T.StructField("__chars", T.LongType())])
    marked = plain.mapInArrow(_marker(shared, names.index("text")), schema)
    passed = marked.where(~F.col("__hit")).select(*names)
    met = marked.where("__hit").join(gone, on=[
        F.col("id").eqNullSafe(F.col("__k")), F.col("__sha") == F.col("__s"), F.col("__chars") == F.col("__c")], how="left_anti")
    return passed.union(met.dropDuplicates(["id", "__sha", "__chars"]).select(*names)).toDF(*docs.columns)
