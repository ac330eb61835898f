"""Conversation prefix trie by fixed-length block hashing.

1. Turns are numbered inside their conversation over a range partitioning (a conversation that
   spans several ranges adds the counts of the ranges before, so none is sorted in one task), and
   conversations are rebuilt from the head of their base conversation and their own tail.
2. A turn's place and content give 128 bits; the digest of a prefix is the XOR of its turns' bits,
   so prefixes are running XORs. Turns are cut into blocks of ``block`` turns, and conversations
   are grouped by the prefix digests at successive block ends.
3. A block is refined only where siblings diverge: if every member of the block before is also in
   this one, one representative's turns give all its nodes, with the members as their weight.
   Elsewhere the members' turns are grouped one by one.
4. Subtree sums need no walk. Every node belongs to its smallest member; a member ``c`` of node v
   brings the values of its own nodes from v's depth on, so a subtree's sum is one grouped sum
   over members, with a running sum along each conversation. Unrefined blocks again add their
   members' totals at once.
5. The ids that end at a node are hashed from chunks of sorted ids, cut and formatted in parallel;
   one task only passes a node's chunks through SHA-256, in constant memory.

Running sums and XORs are taken in two levels, over cells of ``SPAN`` rows and inside a cell.
Tables between the steps are written to the shared folder; nothing reaches the driver.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

BLOCK = 4
SPAN = 4096
#: Ids of one chunk of a node's ending conversations.
CHUNK_IDS = 4096
KEY = ["depth", "hi", "lo"]


# ---------------------------------------------------------------- running sums

def before(df: DataFrame, key: str, pos: str, values: dict[str, str], how, plus, span: int = SPAN) -> DataFrame:
    """``df`` with ``values`` (new name -> column): the rows before by ``pos`` inside ``key``, combined by ``how``.

    ``how`` is the aggregate and ``plus`` adds two of its results; positions are whole numbers from 0.
    """
    cell = F.floor(F.col(pos) / span).alias("__cell")
    rows = df.withColumn("__cell", cell)
    inner = Window.partitionBy(key, "__cell").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(key).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, "__cell").agg(*[how(c).alias(n) for n, c in values.items()])
    earlier = totals.select(key, "__cell", *[how(n).over(outer).alias(f"__{n}") for n in values]).where("__cell > 0")
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({n: F.coalesce(how(c).over(inner), zero) for n, c in values.items()})
    rows = rows.join(earlier, [key, "__cell"], "left")
    return rows.withColumns({n: plus(F.col(n), F.coalesce(f"__{n}", zero)) for n in values}).drop("__cell", *[f"__{n}" for n in values])


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


# ---------------------------------------------------------------- turns

def numbered(turns: DataFrame) -> DataFrame:
    """``turns(c, turn, td, bytes)`` with ``pos``: 1, 2, ... by turn (null first), then content, inside c."""
    order = ["turn", "td", "tie"]
    dealt = (turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("c", *order)
             .withColumn("range", F.spark_partition_id()))
    dealt = written(dealt, "trie-ranges")
    sizes = dealt.groupBy("c", "range").count()
    so_far = Window.partitionBy("c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("c", "range", F.sum("count").over(so_far).alias("earlier")).where("earlier > 0")
    rows = dealt.withColumn("pos", F.row_number().over(Window.partitionBy("c", "range").orderBy(*order)))
    return rows.join(earlier, ["c", "range"], "left").select(
        "c", (F.col("pos") + F.coalesce("earlier", F.lit(0))).cast("long").alias("pos"), "td", "bytes")


def rebuilt(rows: DataFrame, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Numbered turns -> (conversations ``c``, rebuilt turns ``c, pos, td, bytes``).

    A conversation takes the first h turns of its base, the id less its remainder by ``every``, and
    its own turns after its first h, where h is the id's CRC-32 modulo ``heads``.
    """
    sizes = written(rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    own = sizes.select("c", (F.col("c") - F.col("c") % every).alias("base"), (F.crc32(F.col("c").cast("string")) % heads).alias("h"))
    info = own.join(sizes.select(F.col("c").alias("base"), F.col("n").alias("base_n")), "base", "left").select(
        "c", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    info = written(info, "trie-bases")
    head = (rows.where((F.col("c") % every == 0) & (F.col("pos") < heads)).withColumnRenamed("c", "base")
            .join(info, "base").where("pos <= h").select("c", "pos", "td", "bytes"))
    tail = rows.join(info, "c").where("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "td", "bytes")
    return sizes.select("c"), head.unionByName(tail)


def blocks_of(turns: DataFrame, block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """Rebuilt turns -> one row for each conversation and block: its turns, and the prefix digests before and after it."""
    bits = F.md5(F.concat_ws(":", "td", F.col("pos").cast("string")))
    half = lambda at: F.conv(F.substring(bits, at, 16), 16, -10).cast("long")
    rows = turns.withColumns({"hi": half(1), "lo": half(17), "block": F.floor((F.col("pos") - 1) / block)})
    held = rows.groupBy("c", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "hi", "lo", "bytes"))).alias("turns"),  # at most ``block``
        F.bit_xor("hi").alias("xh"), F.bit_xor("lo").alias("xl"))
    held = written(held, "trie-blocks")
    run = before(held, "c", "block", {"ph": "xh", "pl": "xl"}, F.bit_xor, _xor, span)
    return run.select("c", "block", "turns", "ph", "pl", _xor(F.col("ph"), F.col("xh")).alias("eh"), _xor(F.col("pl"), F.col("xl")).alias("el"))


def by_turn(rows: DataFrame, *more: str) -> DataFrame:
    """Blocks -> their turns: the node after each turn, its parent's digest, and ``more`` columns."""
    def upto(n: Column, start: str, half: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), n), F.col(start), lambda a, t: a.bitwiseXOR(t[half]))

    each = F.transform("turns", lambda t, i: F.struct(
        t["pos"].alias("depth"), upto(i + 1, "ph", "hi").alias("hi"), upto(i + 1, "pl", "lo").alias("lo"),
        upto(i, "ph", "hi").alias("up_hi"), upto(i, "pl", "lo").alias("up_lo"), t["bytes"].alias("bytes")))
    return rows.select("c", *more, F.explode(each).alias("t")).select("c", *more, "t.*")


# ---------------------------------------------------------------- ids that end at a node

def _chunks(batches):
    """Ends sorted by (node, id) -> chunks of at most CHUNK_IDS ids, comma-joined."""
    def out(rows):
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("depth", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

    node, held = None, []
    for batch in batches:
        rows = []
        for *key, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key != node or len(held) == CHUNK_IDS:
                if held:
                    rows.append(dict(zip(KEY, node), first=held[0], ids=",".join(map(str, held))))
                node, held = key, []
            held.append(c)
        if rows:
            yield out(rows)
    if held:
        yield out([dict(zip(KEY, node), first=held[0], ids=",".join(map(str, held)))])


def _digests(batches):
    """Chunks sorted by (node, first id) -> SHA-256 of each node's joined ids."""
    def out(node, h):
        return pa.RecordBatch.from_pylist([dict(zip(KEY, node), sha=h.hexdigest())], schema=pa.schema([
            ("depth", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("sha", pa.string())]))

    node, h = None, None
    for batch in batches:
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key != node:
                if node is not None:
                    yield out(node, h)
                node, h = key, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
    if node is not None:
        yield out(node, h)


def end_digests(ends: DataFrame, counts: DataFrame, few: int = CHUNK_IDS) -> DataFrame:
    """``ends(depth, hi, lo, c)`` -> ``depth, hi, lo, sha``. Up to ``few`` ids are joined in a row; more go by chunks."""
    many = counts.where(F.col("n_ends") > few).select(*KEY)
    small = ends.join(many, KEY, "left_anti").groupBy(*KEY).agg(F.sort_array(F.collect_list("c")).alias("ids")).select(
        *KEY, F.sha2(F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))), 256).alias("sha"))
    cut = (ends.join(many, KEY, "left_semi").select(*KEY, "c").repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c")
           .mapInArrow(_chunks, "depth long, hi long, lo long, first long, ids string"))
    large = (cut.repartition(*KEY).sortWithinPartitions(*KEY, "first")
             .mapInArrow(_digests, "depth long, hi long, lo long, sha string"))
    return small.unionByName(large)


# ---------------------------------------------------------------- operator

def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                every: int = 5, heads: int = 9, block: int = BLOCK, span: int = SPAN, few_ends: int = CHUNK_IDS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by number, null first; turns of one number (repeated rows too) are all kept,
    ordered by content. A null role or text counts as empty; rows without a conversation id belong
    to none. The root has depth 0 and members even if they have no turns. An empty table has no
    conversations and gives no rows; texts of any length are hashed whole; other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("td"),
        F.octet_length(text).cast("long").alias("bytes"))
    convs, rows = rebuilt(written(numbered(turns), "trie-turns"), every, heads)
    blocks = written(blocks_of(rows, block, span), "trie-prefixes")
    everyone = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("first")).where("n > 0")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    # groups of conversations by the digest at successive block ends
    full = F.size("turns") == block
    groups = written(blocks.where(full).groupBy("block", "eh", "el").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("first"), F.min("ph").alias("ph"), F.min("pl").alias("pl")), "trie-groups")
    parents = groups.select((F.col("block") + 1).alias("block"), F.col("eh").alias("ph"), F.col("el").alias("pl"), F.col("n").alias("above")).unionByName(
        everyone.select(zero.alias("block"), zero.alias("ph"), zero.alias("pl"), F.col("n").alias("above")))
    parents = written(parents, "trie-parents")
    whole = written(groups.join(parents, ["block", "ph", "pl"]).where("n = above").select("block", "eh", "el", "n", "first"), "trie-whole")

    # turns are refined where siblings diverge, and for one representative of a block that all share
    marked = blocks.where(full).join(whole, ["block", "eh", "el"], "left").select(
        *blocks.columns, F.when(F.col("first").isNull(), one).when(F.col("first") == F.col("c"), F.col("n")).otherwise(zero).alias("weight"),
        F.col("first").isNotNull().alias("shared"))
    marked = written(marked.unionByName(blocks.where(~full).withColumns({"weight": one, "shared": F.lit(False)})), "trie-marked")
    nodes = by_turn(marked.where("weight > 0"), "weight").groupBy(*KEY).agg(
        F.sum("weight").alias("n"), F.min("c").alias("first"), F.min("up_hi").alias("up_hi"), F.min("up_lo").alias("up_lo"), F.max("bytes").alias("bytes"))
    root = everyone.select(*[zero.alias(k) for k in KEY], "n", "first", F.lit(None).cast("long").alias("up_hi"),
                           F.lit(None).cast("long").alias("up_lo"), zero.alias("bytes"))
    nodes = written(nodes.unionByName(root), "trie-nodes")

    # where conversations end; a node at which all its members end is childless
    last = blocks.groupBy("c").agg(F.sum(F.size("turns")).alias("depth"), F.bit_xor(_xor(F.col("ph"), F.col("eh"))).alias("hi"),
                                   F.bit_xor(_xor(F.col("pl"), F.col("el"))).alias("lo"))
    ends = written(convs.join(last, "c", "left").select("c", *[F.coalesce(k, zero).alias(k) for k in KEY]), "trie-ends")
    end_counts = written(ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_ends")), "trie-end-counts")
    leaves = nodes.join(end_counts, KEY).where("n = n_ends").select(F.col("first").alias("c"), one.alias("leaf"))

    # what a conversation's own shared nodes save, from each depth on
    own = nodes.where("n > 1").select(F.col("first").alias("c"), "depth", ((F.col("n") - 1) * F.col("bytes")).alias("value"))
    own = written(before(own, "c", "depth", {"earlier": "value"}, F.sum, lambda a, b: a + b, span), "trie-own")
    totals = own.groupBy("c").agg(F.sum("value").alias("total"), F.min("depth").alias("top"))
    suffix = own.join(totals, "c").select("c", "depth", (F.col("total") - F.col("earlier")).alias("suffix"))
    known = leaves.join(totals, "c", "full").select("c", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("total", zero).alias("total"), "top")
    known = written(known, "trie-known")

    # subtree sums: a single member's node has one leaf and saves nothing
    counted = written(marked.where("not (shared and weight = 1)").join(known, "c", "left").withColumns(
        {"leaf": F.coalesce("leaf", zero), "total": F.coalesce("total", zero)}), "trie-counted")
    others = counted.where("weight = 0").groupBy("block", "eh", "el").agg(F.sum("leaf").alias("more_leaves"), F.sum("total").alias("more"))
    refined = counted.where("weight > 0").join(others.withColumn("shared", F.lit(True)), ["block", "eh", "el", "shared"], "left")
    parts = by_turn(refined, "leaf", "total", "top", "more_leaves", "more").join(suffix, ["c", "depth"], "left").select(
        *KEY, (F.col("leaf") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.when(F.col("depth") < F.col("top"), F.col("total")).otherwise(F.coalesce("suffix", zero)) + F.coalesce("more", zero)).alias("saved"))
    sums = parts.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).where("depth > 0")
    root_sums = known.agg(F.sum("leaf").alias("leaves"), F.sum("total").alias("saved")).select(*[zero.alias(k) for k in KEY], "leaves", "saved")

    # one grouping brings a node's figures together
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("children"))
    figures = ["n", "first", "up_hi", "up_lo", "children", "leaves", "saved", "sha"]
    pieces = [nodes.drop("bytes"), children, sums, root_sums, end_digests(ends, end_counts, few_ends)]
    table = pieces[0]
    for piece in pieces[1:]:
        table = table.unionByName(piece, allowMissingColumns=True)
    table = written(table.groupBy(*KEY).agg(*[F.max(f).alias(f) for f in figures]).where("n is not null"), "trie-figures")
    above = table.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("first").alias("parent"))
    single = F.col("n") == 1
    return table.join(written(above, "trie-above"), ["depth", "up_hi", "up_lo"], "left").select(
        F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", zero).alias("n_children"), F.when(single, one).otherwise(F.coalesce("leaves", zero)).alias("n_leaves"),
        F.when(single, zero).otherwise(F.coalesce("saved", zero)).alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
