"""SimHash near-duplicates by a binary trie self-join.

Fingerprints. The words of the lower-cased text (A-Z only) are joined by single spaces; each
word shingle is hashed with XXH64, and a bit of the fingerprint is 1 if it is set in over half of
the hashes.

Links. Distinct fingerprints form a binary trie that is joined with itself: two nodes are walked
together, the bits in which their paths differ are added up, and a pair of nodes is dropped as
soon as the sum exceeds the budget ``max_bits``. To spread the walk over the cluster, the
fingerprint is cut into ``max_bits + 1`` segments and the trie is walked once for each rotation
that puts a segment on top: two fingerprints within the budget agree in at least one segment
entirely, so the top segment is walked with a budget of zero, and its nodes are the tasks' keys.
A node pair with more than ``node_rows`` rows is walked ``STEP`` bits further as a distributed
step (each row goes to the child pairs that the budget still allows) until it fits, so no group,
however large, meets in one task whole.

Inside a task the node pairs of many groups are walked level by level with array operations. A
task returns for each linked fingerprint one link to the least of its local group, never all
pairs; connected components over these links give the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .bitfilter import without
from .common import positional, texts, written
from .components import components

SEED = 42
BITS = 64
STEP = 6
NODE_ROWS = 50_000
#: Node pairs that the walk of one task expands at once, and shingles hashed at once.
FRONTIER = 1 << 18
CHUNK = 1 << 16


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    n, counts, h = len(ends), np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        hashes = np.array([h(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in texts(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` of every row; the fingerprint is the signed form of its 64 bits."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_fingerprints(shingle), f"id {two.schema['id'].dataType.simpleString()}, fp long")


# ---------------------------------------------------------------- the walk inside a task

def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a[i] and b[i]; parent points at the least member."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def walk(values: np.ndarray, pairs: np.ndarray, top: np.ndarray, budget: int, parent: np.ndarray) -> None:
    """Walks node pairs through the trie of ``values`` and unites what is within the budget.

    ``values``: uint64, ascending inside every node; ``pairs``: rows (from, to, from, to, differing
    bits so far), a node with itself or two nodes; ``top``: each pair's highest bit not walked yet.
    """
    counts: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in counts:
            if len(counts) >= 8:
                counts.clear()
            c = np.zeros(len(values) + 1, np.int64)
            np.cumsum((values >> np.uint64(bit)) & np.uint64(1), out=c[1:])
            counts[bit] = c
        return counts[bit]

    stack = [(int(b), pairs[top == b]) for b in np.unique(top)]
    while stack:
        bit, p = stack.pop()
        same = p[:, 0] == p[:, 2]
        left, right = p[:, 1] - p[:, 0], p[:, 3] - p[:, 2]
        ends = ~same & (left == 1) & (right == 1)
        if ends.any():
            e = p[ends]
            near = np.bitwise_count(values[e[:, 0]] ^ values[e[:, 2]]) <= budget
            _union(parent, e[near, 0], e[near, 2])
        p = p[~ends & ~(same & (left == 1))]
        if not len(p) or bit < 0:
            continue
        if len(p) > FRONTIER:
            stack += [(bit, p[i: i + FRONTIER]) for i in range(0, len(p), FRONTIER)]
            continue
        c = ones(bit)
        cut_a = p[:, 1] - (c[p[:, 1]] - c[p[:, 0]])
        cut_b = p[:, 3] - (c[p[:, 3]] - c[p[:, 2]])
        same = p[:, 0] == p[:, 2]
        zeros = np.column_stack([p[:, 0], cut_a, p[:, 2], cut_b, p[:, 4]])
        both = np.column_stack([cut_a, p[:, 1], cut_b, p[:, 3], p[:, 4]])
        cross = np.column_stack([p[:, 0], cut_a, cut_b, p[:, 3], p[:, 4] + 1])
        back = np.column_stack([cut_a, p[:, 1], p[:, 2], cut_b, p[:, 4] + 1])[~same]
        out = np.concatenate([zeros, both, cross, back])
        out = out[(out[:, 0] < out[:, 1]) & (out[:, 2] < out[:, 3]) & (out[:, 4] <= budget)]
        if len(out):
            stack.append((bit - 1, out))


def _leaf_links(budget: int):
    """Rows sorted by node pair, side and value -> one link for each value that is not its class's least."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(cols):
        r, a, b, depth, diff, side, v = cols
        new = np.ones(len(v), bool)
        new[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(v))
        own = a[start] == b[start]
        ones = np.concatenate([[0], np.cumsum(side)])
        cut = end - (ones[end] - ones[start])
        pairs = np.column_stack([start, np.where(own, end, cut), np.where(own, start, cut), end, diff[start]])
        alive = (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & (end - start > 1)
        parent = np.arange(len(v))
        values = v.view(np.uint64)
        walk(values, pairs[alive], BITS - 1 - depth[start][alive], budget, parent)
        moved = np.flatnonzero(parent != np.arange(len(v)))
        turn = r.astype(np.uint64)

        def back(i):  # undo the rotation
            x, s = values[i], turn[i]
            return np.where(s == 0, x, (x >> s) | (x << ((np.uint64(BITS) - s) % np.uint64(BITS)))).view(np.int64)

        return pa.record_batch([pa.array(back(moved)), pa.array(back(parent[moved]))], schema=schema)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            held.append(cols)
            rows += len(cols[0])
            if rows < 4 * NODE_ROWS:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]) | (cols[3] != cols[3][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield links([c[:cut] for c in cols])
            held, rows = [[c[cut:] for c in cols]], len(cols[0]) - cut
        if rows:
            yield links([np.concatenate(x) for x in zip(*held)])

    return run


# ---------------------------------------------------------------- the distributed walk

def _rotations(max_bits: int) -> list[tuple[int, int]]:
    """(rotation to the left, length of the segment then on top) for max_bits + 1 segments."""
    parts = max_bits + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(parts)]


def trie_links(fps: DataFrame, max_bits: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """``fps(fp)``, distinct -> links ``(u, v)`` that connect all fingerprints within ``max_bits``."""
    turned = []
    for s, length in _rotations(max_bits):
        v = F.col("fp") if s == 0 else F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", BITS - s))
        top = F.lit(0).cast("long") if length == 0 else F.shiftrightunsigned(v, BITS - length) if length < BITS else v
        turned.append(F.struct(F.lit(s).alias("r"), top.alias("a"), F.lit(length).alias("depth"), v.alias("v")))
    rows = fps.select(F.explode(F.array(*turned)).alias("x")).select(
        "x.r", "x.a", F.col("x.a").alias("b"), "x.depth", F.lit(0).alias("diff"), F.lit(0).alias("side"), "x.v")
    key = ["r", "a", "b", "depth"]
    ready: list[DataFrame] = []
    while True:
        hot = written(rows.groupBy(*key).count().where(F.col("count") > node_rows).where(F.col("depth") < BITS)
                      .select(*key), "simhash-hot")
        if hot.isEmpty():
            break
        ready.append(rows.join(hot, key, "left_anti"))
        rows = written(_descend(rows.join(hot, key, "left_semi"), max_bits), "simhash-nodes")
    ready.append(rows)
    all_rows = ready[0]
    for more in ready[1:]:
        all_rows = all_rows.unionByName(more)
    # a node pair of one row has no link
    return (all_rows.repartition(*key).sortWithinPartitions(*key, "side", F.expr("v ^ (-9223372036854775807L - 1L)"))
            .mapInArrow(_leaf_links(max_bits), "u long, v long").distinct())


def _descend(rows: DataFrame, max_bits: int) -> DataFrame:
    """One distributed step: each row goes to the child pairs that the budget still allows."""
    masks = [(m, bin(m).count("1")) for m in range(1 << STEP) if bin(m).count("1") <= max_bits]
    step = F.least(F.lit(STEP), F.lit(BITS) - F.col("depth"))
    child = F.expr(f"v >> (64 - depth - least({STEP}, 64 - depth)) & ((1 << least({STEP}, 64 - depth)) - 1)").cast("long")
    out = (rows.withColumn("c", child).withColumn("step", step)
           .withColumn("m", F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("x"), F.lit(n).alias("n")) for m, n in masks])))
           .where((F.col("diff") + F.col("m.n") <= max_bits) & (F.col("m.x") < F.expr("1 << step"))))
    own = F.col("a") == F.col("b")
    other = F.col("c").bitwiseXOR(F.col("m.x"))
    first = (own & (F.col("c") <= other)) | (~own & (F.col("side") == 0))
    return out.select(
        "r", F.expr("a << step").bitwiseOR(F.when(first, F.col("c")).otherwise(other)).alias("a"),
        F.expr("b << step").bitwiseOR(F.when(first, other).otherwise(F.col("c"))).alias("b"),
        (F.col("depth") + F.col("step")).alias("depth"), (F.col("diff") + F.col("m.n")).alias("diff"),
        F.when(first, 0).otherwise(1).alias("side"), "v")


# ---------------------------------------------------------------- operator

def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Near-duplicate classes: ``<id_col>, fingerprint, component_id`` for every row.

    Two rows are linked if their fingerprints differ in at most ``max_bits`` bits; the class is
    named by its smallest id. A null, empty or blank text has fingerprint zero and is linked like
    any other; fewer words than a shingle make one shingle. Repeated rows give one result row
    each; null ids do not name a class (null if a class has no other). An empty table gives no
    rows; other columns are ignored.
    """
    held = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = written(held.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(trie_links(distinct.select("fp"), max_bits, node_rows))
    named = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root"))
    named = written(named, "simhash-roots")
    # written first: the joins below are plain shuffles on both sides, so a hot class is split at run time
    least = written(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    classes = written(named.join(least, "root").select("fp", "component_id"), "simhash-classes")
    return held.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The row of each near-duplicate class that stays: its smallest id; rows without an id stay.

    Repeated rows of that id stay together. All columns are returned.
    """
    plain, names = positional(docs, id=id_col, text=text_col)
    classes = simhash_dedup(plain, "id", "text", **params)
    gone = written(classes.where("id != component_id").select(F.col("id").alias("__gone")).distinct(), "simhash-gone")
    return without(plain, "id", gone).toDF(*docs.columns)
