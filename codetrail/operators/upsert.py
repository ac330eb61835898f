"""Materializations on plain Parquet: table, full refresh, keyed delete+insert, merge,
replacement by predicate, append with de-duplication, and compaction.

There is no MERGE/DELETE on plain Parquet, so a keyed upsert rewrites only the
*partitions it touches*:

1. reject a batch whose columns differ from the table's, NULL keys (a NULL key never matches, so
   it would be inserted again and again) and NULL partition values;
2. touched = partitions of the batch, plus -- only when the key does not contain the
   partition columns -- partitions holding an old row with a batch key;
3. new = target[touched] minus rows whose key is in the batch (left anti join), plus the batch;
4. write ``new`` with dynamic partition overwrite, so untouched partitions are not read,
   shuffled or rewritten; partitions that became empty are removed afterwards.

Step 2 reads the key column of the whole target unless ``target_predicate`` bounds it (a bound on
the partition column prunes partitions) or the key contains the partition columns. A table written
with ``lookup_limit`` has Parquet Bloom filters on the key, so a batch of few keys skips the row
groups that cannot hold them (same result).

Unpartitioned tables (the small daily metric table) are rewritten whole into a fresh
directory that is then swapped in, mirroring temp -> rename -> drop.

The only driver-side values are the touched partition values (at most ``MAX_PARTITIONS``; more
are refused) and the pass/fail counts of the key checks.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codetrail.functions.literals import isin, typed_lit
from codetrail.session import ensure_conf, hadoop_fs, path_exists

#: Partition values that one upsert may touch (they are listed on the driver).
MAX_PARTITIONS = 100_000
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


class UniqueKeyViolation(ValueError):
    """A unique-key precondition of the upsert does not hold."""


class SchemaChanged(ValueError):
    """The batch's columns differ from the table's; only a full refresh may change them."""


class TooManyPartitions(ValueError):
    """The batch touches more partitions than an upsert lists on the driver."""


@dataclass
class UpsertResult:
    """``touched_partitions``: values (tuples for several partition columns); ``rows``: rows of the batch, None if not counted;
    ``observed``: what the write counted for the quality rules, if asked."""

    path: str
    strategy: str
    first_run: bool
    touched_partitions: list
    emptied_partitions: list
    rows: int | None = None
    observed: Observation | None = None


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def null_key_rows(df: DataFrame, keys) -> Column:
    cond = None
    for k in _cols(keys):
        c = F.col(f"`{k}`").isNull()
        cond = c if cond is None else (cond | c)
    return cond


def assert_no_null_keys(df: DataFrame, keys) -> None:
    if df.where(null_key_rows(df, keys)).limit(1).count() > 0:
        raise UniqueKeyViolation(f"batch has NULL values in unique key {list(_cols(keys))}")


def assert_unique_keys(df: DataFrame, keys) -> None:
    k = _cols(keys)
    dup = df.groupBy(*[F.col(f"`{c}`") for c in k]).count().where(F.col("count") > 1)
    if dup.limit(1).count() > 0:
        raise UniqueKeyViolation(f"batch has duplicate values of unique key {k}")


def _swap_in(spark: SparkSession, new_path: str, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    backup = None
    if fs.exists(p):
        backup = jpath(f"{path}.__old-{uuid.uuid4().hex[:8]}")
        if not fs.rename(p, backup):
            raise IOError(f"cannot move {path} aside")
    else:
        fs.mkdirs(p.getParent())
    if not fs.rename(jpath(new_path), p):
        if backup is not None:
            fs.rename(backup, p)
        raise IOError(f"cannot move {new_path} to {path}")
    if backup is not None:
        fs.delete(backup, True)


def balanced(df: DataFrame, partition_by: str | list[str] | None = None) -> DataFrame:
    """AQE ``rebalance`` before a write: rows of one output partition are gathered into a few
    tasks (split or merged to the advisory size), so a write does not leave one small file per
    task in every partition directory it touches."""
    return df.hint("rebalance", *_cols(partition_by)) if partition_by else df.hint("rebalance")


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None = None, mode: str = "overwrite",
                rebalance: bool = True) -> None:
    """Table materialization (optionally partitioned, K7).

    ``rebalance=False`` skips the shuffle when every task already holds one output partition's
    rows -- a map-only projection of a source partitioned the same way (model 1).
    """
    w = (balanced(df, partition_by) if rebalance else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*_cols(partition_by))
    w.parquet(path)


def full_refresh(spark: SparkSession, df: DataFrame, path: str, partition_by=None,
                 rebalance: bool = True) -> UpsertResult:
    """K2/K6: build into a new directory, then swap it in; readers never see a half table."""
    ensure_conf(spark)
    tmp = f"{path}.__new-{uuid.uuid4().hex[:8]}"
    write_table(df, tmp, partition_by, rebalance=rebalance)
    _swap_in(spark, tmp, path)
    return UpsertResult(path, "full_refresh", True, [], [])


class EmptyRefresh(ValueError):
    """A switched table cannot be rebuilt from no rows."""


def refresh_switch(spark: SparkSession, df: DataFrame, name: str, root: str, partition_by=None, keep: int = 1) -> UpsertResult:
    """K2/K6 without a rename: build a new version under ``root`` and switch the catalog name to it.

    Nothing is copied and there is always a table: readers of ``name`` (a catalog view over the
    version's files, so partitions are still pruned) see the old version until the switch and the
    new one after it. ``keep`` older versions stay for readers that have started; older ones go.
    A driver lost before the switch leaves the old version in place and an unused folder, which
    the next refresh removes.
    """
    ensure_conf(spark)
    version = f"{root.rstrip('/')}/v-{time.time_ns():020d}"
    write_table(df, version, partition_by)
    if not spark.read.schema(df.schema).parquet(version).inputFiles():
        raise EmptyRefresh(f"no rows to build {name} from; the table is left as it is")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{version}`")
    fs, p = hadoop_fs(spark, root)
    versions = {st.getPath().getName(): st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("v-")}
    for old in sorted(versions)[:-1 - keep]:
        fs.delete(versions[old], True)
    return UpsertResult(version, "switch", False, [], [])


def _delete_partitions(spark: SparkSession, path: str, columns: list[str], values) -> None:
    """Remove the directories of the given partition values (found by listing level by level, so
    the directory-name escaping is Spark's own)."""
    from urllib.parse import unquote

    wanted = [tuple(NULL_DIRECTORY if x is None else str(x) for x in v) for v in values]
    if not wanted:
        return
    fs, root = hadoop_fs(spark, path)
    level = [(root, ())]
    for i, column in enumerate(columns):
        heads, below = {w[: i + 1] for w in wanted}, []
        for folder, so_far in level:
            for st in fs.listStatus(folder):
                name = st.getPath().getName()
                if st.isDirectory() and name.startswith(f"{column}="):
                    value = (*so_far, unquote(name.split("=", 1)[1]))
                    if value in heads:
                        below.append((st.getPath(), value))
        level = below
    for folder, _ in level:
        fs.delete(folder, True)


def _partition_text(v) -> str | None:
    """A partition value as Spark casts it to text; None if only Spark can tell."""
    if v is None:
        return NULL_DIRECTORY
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (str, int)):
        return str(v)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return v.isoformat()
    return None


def _partition_key(columns) -> Column:
    """The partition columns as one text, nulls included."""
    return F.concat_ws("\x01", *[F.coalesce(c.cast("string"), F.lit(NULL_DIRECTORY)) for c in columns])


def in_partitions(columns: list[str], values: list[tuple]) -> Column:
    """Rows of the given partitions: one IN list whatever their number, over partition columns only, so the scan prunes directories."""
    cols = [F.col(f"`{c}`") for c in columns]
    if len(columns) == 1:
        some = [v[0] for v in values if v[0] is not None]
        cond = isin(cols[0], some) if some else F.lit(False)
        return cond | cols[0].isNull() if len(some) < len(values) else cond
    texts = [[_partition_text(x) for x in v] for v in values]
    wanted = ["\x01".join(t) if None not in t else _partition_key([typed_lit(x) if x is not None else F.lit(None) for x in v])
              for t, v in zip(texts, values)]
    return _partition_key(cols).isin(wanted) if wanted else F.lit(False)


def check_schema(spark: SparkSession, path: str, batch: DataFrame, partition_by: list[str]) -> None:
    """Raise unless the stored table has the batch's columns (names, and types outside the partition columns)."""
    try:
        stored = spark.read.parquet(path).schema
    except Exception as e:  # a table without files has no columns to compare
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return
        raise
    have = {f.name: None if f.name in partition_by else f.dataType.simpleString() for f in stored.fields}
    want = {f.name: None if f.name in partition_by else f.dataType.simpleString() for f in batch.schema.fields}
    if have != want:
        changed = sorted(c for c in have.keys() | want.keys() if have.get(c, "-") != want.get(c, "-"))
        raise SchemaChanged(f"columns {changed} differ between the batch and {path}; run a full refresh")


def _order(values) -> list:
    return sorted(values, key=lambda v: tuple((x is None, x) for x in v))


def _plain(columns: list[str], values: list[tuple]) -> list:
    """Partition values as callers see them: bare for one column."""
    return [v[0] for v in values] if len(columns) == 1 else list(values)


def delete_insert(spark: SparkSession, batch: DataFrame, path: str, unique_key, partition_by: str | list[str] | None = None,
                  target_predicate: Column | None = None, strategy: str = "delete+insert",
                  rebalance: bool = True, lookup_limit: int = 0) -> UpsertResult:
    """K3: delete target rows whose key is in the batch, insert the whole batch.

    ``lookup_limit`` (one key column, partitioned tables): files get Bloom filters on the key, and a
    batch of at most so many distinct keys looks its old rows up by value; a larger one joins.

    ``target_predicate`` (K8) limits which target rows are looked at and may be deleted; rows
    outside it are kept even when their key is in the batch (so duplicates can remain, as
    documented). The batch is not de-duplicated (use :func:`dedupe_latest` first if needed).
    """
    ensure_conf(spark)
    # The batch is used up to three times (partition stats, old-key lookup, write): keep it
    # once. Lost blocks are recomputed from lineage, so executor loss is tolerated.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _delete_insert(spark, batch, path, unique_key, partition_by, target_predicate, strategy, rebalance, lookup_limit)
    finally:
        batch.unpersist()


IN_PUSHDOWN = "spark.sql.parquet.pushdown.inFilterThreshold"
#: Keys of one IN list: the Parquet reader walks a list value by value, one stack frame deeper for each.
LOOKUP_GROUP = 250


@contextmanager
def _pushed_keys(spark: SparkSession, n: int):
    """The IN lists of ``n`` looked up keys reach the Parquet reader as values, not as their range; the setting comes back afterwards."""
    before = spark.conf.get(IN_PUSHDOWN)
    spark.conf.set(IN_PUSHDOWN, str(max(int(before), min(n, LOOKUP_GROUP))))
    try:
        yield
    finally:
        spark.conf.set(IN_PUSHDOWN, before)


def _any_of(conditions: list[Column]) -> Column:
    """``a OR b OR ...`` as a balanced tree, so its depth is the logarithm of its length."""
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) // 2 * 2:]
    return conditions[0] if conditions else F.lit(False)


def _all_of(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for c in conditions[1:]:
        whole = whole & c
    return whole


def old_rows(seen: DataFrame, key_df: DataFrame, keys: list[str], lookup_limit: int) -> tuple[DataFrame, int]:
    """Rows of ``seen`` whose key is in ``key_df``, and the number of key values looked up (0: by a join)."""
    if lookup_limit and len(keys) == 1:
        values = [r[0] for r in key_df.where(F.col(f"`{keys[0]}`").isNotNull()).distinct().limit(lookup_limit + 1).collect()]
        if len(values) <= lookup_limit:
            values = [F.lit(bytes(v) if isinstance(v, bytearray) else v) for v in values]
            groups = [values[i:i + LOOKUP_GROUP] for i in range(0, len(values), LOOKUP_GROUP)]
            return seen.where(_any_of([F.col(f"`{keys[0]}`").isin(g) for g in groups])), len(values)
    return seen.join(key_df, keys, "left_semi"), 0


def _write_partitions(df: DataFrame, path: str, parts: list[str], rebalance: bool, index_key: str | None, dynamic: bool = True) -> None:
    """Write partitions; with ``index_key`` with Bloom filters on it, sized by their distinct values."""
    df = balanced(df, parts) if rebalance else df
    w = df.write.mode("overwrite").partitionBy(*parts)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if index_key:
        w = w.option(f"parquet.bloom.filter.enabled#{index_key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(path)


def _delete_insert(spark, batch, path, unique_key, partition_by, target_predicate, strategy,
                   rebalance=True, lookup_limit=0) -> UpsertResult:
    keys, parts = _cols(unique_key), _cols(partition_by) if partition_by else []
    exists = path_exists(spark, path)
    if exists:
        check_schema(spark, path, batch, parts)
    # Read the target with the batch's schema: an existing table may hold no files at all.
    target = spark.read.schema(batch.schema).parquet(path) if exists else None
    key_df = batch.select(*[F.col(f"`{c}`") for c in keys])

    if not parts:
        counts = batch.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(null_key_rows(batch, keys), 1)).alias("bad")).first()
        if counts["bad"]:
            raise UniqueKeyViolation(f"batch has NULL values in unique key {keys}")
        if target is None:
            write_table(batch, path)
            return UpsertResult(path, strategy, True, [], [], counts["n"])
        new = _kept(target, key_df, keys, target_predicate).unionByName(batch)
        _rewrite(spark, new, path)
        return UpsertResult(path, strategy, False, [], [], counts["n"])

    # One job answers three questions: which partitions the batch writes, whether it has NULL
    # keys, and -- only when the key lacks a partition column, so an old row of a batch key
    # may sit in another partition -- which partitions hold old rows of the batch keys.
    values = [F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(parts)]
    marks = batch.select(*values, F.when(null_key_rows(batch, keys), 1).otherwise(0).alias("_null"), F.lit(1).alias("_batch"))
    looked_up, index_key = 0, keys[0] if lookup_limit and len(keys) == 1 else None
    if target is not None and not set(parts) <= set(keys):
        seen = target if target_predicate is None else target.where(target_predicate)
        old, looked_up = old_rows(seen, key_df, keys, lookup_limit)
        marks = marks.unionByName(old.select(*values, F.lit(0).alias("_null"), F.lit(0).alias("_batch")))
    with _pushed_keys(spark, looked_up):
        stats = (marks.groupBy(*[f"_p{i}" for i in range(len(parts))])
                 .agg(F.sum("_null").alias("null_keys"), F.sum("_batch").alias("n")).limit(MAX_PARTITIONS + 1).collect())
    if len(stats) > MAX_PARTITIONS:
        raise TooManyPartitions(f"the batch touches more than {MAX_PARTITIONS} partitions of {path}")
    if any(r["null_keys"] for r in stats):
        raise UniqueKeyViolation(f"batch has NULL values in unique key {keys}")
    by_value = {tuple(r[f"_p{i}"] for i in range(len(parts))): r["n"] for r in stats}
    if any(n and None in v for v, n in by_value.items()):
        raise UniqueKeyViolation(f"batch has NULL values in partition columns {parts}")
    rows, touched = sum(by_value.values()), _order(by_value)
    if target is None:
        _write_partitions(batch, path, parts, rebalance, index_key, dynamic=False)
        return UpsertResult(path, strategy, True, _plain(parts, touched), [], rows)

    candidates = _order(v for v, n in by_value.items() if not n)   # old rows only, nothing new
    scope = target.where(in_partitions(parts, touched)) if touched else target.limit(0)
    kept = _kept(scope, key_df, keys, target_predicate)

    emptied: list = []
    if candidates:
        alive = {tuple(r) for r in kept.where(in_partitions(parts, candidates)).select(*[F.col(f"`{c}`") for c in parts]).distinct().collect()}
        emptied = [v for v in candidates if v not in alive]

    new = kept.unionByName(batch)
    # Dynamic overwrite replaces exactly the partitions present in `new`.
    _write_partitions(new, path, parts, rebalance, index_key)
    _delete_partitions(spark, path, parts, emptied)
    return UpsertResult(path, strategy, False, _plain(parts, touched), _plain(parts, emptied), rows)


def _rewrite(spark: SparkSession, df: DataFrame, path: str) -> None:
    tmp = f"{path}.__new-{uuid.uuid4().hex[:8]}"
    write_table(df, tmp)
    _swap_in(spark, tmp, path)


def replace_where(spark: SparkSession, batch: DataFrame, path: str, predicate: Column) -> UpsertResult:
    """Replace all rows of an unpartitioned table for which ``predicate`` holds by the batch.

    Rows that vanished are removed even if the batch has nothing in their place. Every row of the
    batch must satisfy the predicate.
    """
    ensure_conf(spark)
    inside = F.coalesce(predicate, F.lit(False))
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = batch.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~inside, 1)).alias("bad")).first()
        if counts["bad"]:
            raise ValueError(f"{counts['bad']} rows of the batch lie outside the replaced range")
        first = not path_exists(spark, path)
        if first:
            write_table(batch, path)
        else:
            check_schema(spark, path, batch, [])
            _rewrite(spark, spark.read.schema(batch.schema).parquet(path).where(~inside).unionByName(batch), path)
        return UpsertResult(path, "replace", first, [], [], counts["n"])
    finally:
        batch.unpersist()


def replace_partitions(spark: SparkSession, batch: DataFrame, path: str, partition_by: str, values: list,
                       found: set | None = None) -> UpsertResult:
    """Replace whole partitions by the batch: its rows are all that the partitions ``values`` hold afterwards.

    No key is looked up, so nothing of the target is read, and rows that vanished are removed.
    Every row of the batch must lie in ``values``. ``found``: exactly the partitions that the batch has rows of, from
    a caller that knows them and has dealt the rows by partition; the batch is then used once, written as it comes.
    """
    ensure_conf(spark)
    if len(values) > MAX_PARTITIONS:
        raise TooManyPartitions(f"{len(values)} partitions of {path} are to be replaced, more than {MAX_PARTITIONS}")
    if found is not None:
        return _replace_found(spark, batch, path, partition_by, values, found, None)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r[0]: r["n"] for r in batch.groupBy(F.col(f"`{partition_by}`")).agg(F.count(F.lit(1)).alias("n")).limit(len(values) + 1).collect()}
        return _replace_found(spark, balanced(batch, partition_by), path, partition_by, values, set(counts), sum(counts.values()))
    finally:
        batch.unpersist()


def _replace_found(spark: SparkSession, batch: DataFrame, path: str, partition_by: str, values: list, found: set, rows: int | None) -> UpsertResult:
    if not found <= set(values):
        raise ValueError(f"rows of the batch lie outside the replaced partitions of {path}")
    first = not path_exists(spark, path)
    if not first:
        check_schema(spark, path, batch, [partition_by])
    if found or first:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    emptied = [v for v in values if v not in found]
    if not first:
        _delete_partitions(spark, path, [partition_by], [(v,) for v in emptied])
    return UpsertResult(path, "replace", first, sorted(found), emptied, rows)


def _kept(scope: DataFrame, key_df: DataFrame, keys: list[str], target_predicate: Column | None) -> DataFrame:
    if target_predicate is None:
        return scope.join(key_df, keys, "left_anti")
    p = F.coalesce(target_predicate, F.lit(False))
    cols = scope.columns
    outside = scope.where(~p)
    inside = scope.where(p).join(key_df, keys, "left_anti").select(*[F.col(f"`{c}`") for c in cols])
    return outside.unionByName(inside)


def merge(spark: SparkSession, batch: DataFrame, path: str, unique_key, partition_by: str | list[str] | None = None,
          target_predicate: Column | None = None, rebalance: bool = True) -> UpsertResult:
    """K4: update-or-insert by key. Requires unique batch keys; then equal to delete+insert."""
    ensure_conf(spark)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assert_unique_keys(batch, unique_key)
        return _delete_insert(spark, batch, path, unique_key, partition_by, target_predicate, "merge", rebalance)
    finally:
        batch.unpersist()


def dedupe_latest(df: DataFrame, unique_key, order_by: str | list[str]) -> DataFrame:
    """Keep one row per key -- the greatest by ``order_by`` (ties broken by the other columns).

    Written as ``max(struct(order..., rest...))`` per key instead of ``row_number()`` over a
    window: max is partially aggregated map-side, so a key owning a huge share of rows is
    collapsed before the shuffle instead of being sorted in one task.
    """
    keys = _cols(unique_key)
    order = _cols(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(f"`{c}`") for c in rest])
    agg = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.max(packed).alias("_r"))
    named = [F.col(f"_r.o{i}").alias(c) for i, c in enumerate(order)] + [F.col(f"_r.`{c}`").alias(c) for c in rest]
    return agg.select(*[F.col(f"`{c}`") for c in keys], *named).select(*[F.col(f"`{c}`") for c in df.columns])


#: Repeated keys that :func:`dedupe_repeated` sends to every task.
FEW_REPEATED = 100_000


def dedupe_repeated(df: DataFrame, unique_key, order_by: str | list[str]) -> DataFrame:
    """The rows of :func:`dedupe_latest` where few keys are repeated: only the rows of those are grouped.

    Grouping whole rows sorts them twice and moves them once; here their keys are counted, and rows of a key that
    comes once stay where they are. ``df`` is used up to three times, so the caller keeps it. Many repeated
    keys are grouped as before.
    """
    keys = _cols(unique_key)
    named = [F.col(f"`{k}`") for k in keys]
    repeated = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*named)
    found = repeated.limit(FEW_REPEATED + 1).collect()
    if not found:
        return df
    if len(found) > FEW_REPEATED:
        return dedupe_latest(df, keys, order_by)
    few = F.broadcast(df.sparkSession.createDataFrame(found, repeated.schema))
    on = _all_of([df[f"`{k}`"].eqNullSafe(few[f"`{k}`"]) for k in keys])
    return df.join(few, on, "left_anti").unionByName(dedupe_latest(df.join(few, on, "left_semi"), keys, order_by))


def append(spark: SparkSession, batch: DataFrame, path: str, unique_key=None, partition_by: str | list[str] | None = None,
           dedupe_order_by=None, skip_existing: bool = False) -> UpsertResult:
    """K5: append only. Optionally de-duplicate the batch (W1) and skip keys already stored."""
    ensure_conf(spark)
    if dedupe_order_by is not None:
        batch = dedupe_latest(batch, unique_key, dedupe_order_by)
    first = not path_exists(spark, path)
    if skip_existing and not first:
        target = spark.read.schema(batch.schema).parquet(path)
        batch = batch.join(target.select(*_cols(unique_key)), _cols(unique_key), "left_anti")
    write_table(batch, path, partition_by, mode="append")
    return UpsertResult(path, "append", first, [], [])


BATCH = "_batch"


def append_once(spark: SparkSession, batch: DataFrame, path: str, batch_id: str, partition_by: str | list[str] | None = None) -> UpsertResult:
    """K5, exactly once: a batch that was appended before is skipped, without a look at the target's keys.

    The batch's rows lie in a directory of their own (partition column ``_batch``), and a ledger
    beside the table names the batches that are complete. A batch that failed half-way is not in
    the ledger; its retry replaces its directory and nothing else.
    """
    ensure_conf(spark)
    parts = [BATCH, *(_cols(partition_by) if partition_by else [])]
    first = not path_exists(spark, path)
    if batch_id in complete_batches(spark, path, batch_id):
        return UpsertResult(path, "append", first, [], [], 0)
    if first is False:
        check_schema(spark, path, batch.withColumn(BATCH, F.lit(batch_id)), parts)
    (balanced(batch.withColumn(BATCH, F.lit(batch_id)), parts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    (spark.range(1).select(F.current_timestamp().alias("completed"), F.lit(batch_id).alias(BATCH)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{path}_ledger"))
    return UpsertResult(path, "append", first, [batch_id], [])


def complete_batches(spark: SparkSession, path: str, batch_id: str) -> list[str]:
    """``[batch_id]`` if the ledger names it, else none (one directory of the ledger is looked at)."""
    ledger = f"{path}_ledger"
    if not path_exists(spark, ledger):
        return []
    found = spark.read.schema(f"completed timestamp, {BATCH} string").parquet(ledger).where(F.col(BATCH) == batch_id)
    return [batch_id] if found.limit(1).count() else []


def read_appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a table written by :func:`append_once`: complete batches only."""
    from pyspark.sql import types as T

    wide = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    done = spark.read.schema(f"completed timestamp, {BATCH} string").parquet(f"{path}_ledger").select(BATCH)
    return spark.read.schema(wide).parquet(path).join(done, BATCH, "left_semi").select(*[F.col(f"`{f.name}`") for f in schema.fields])


def apply_changes(spark: SparkSession, upserts: DataFrame, gone: DataFrame, path: str, unique_key, partition_by: str) -> UpsertResult:
    """Apply known changes to a table: rows to insert, and the keys of old rows with the partition that holds each.

    ``gone``: key columns and the old row's partition; the partitions of both are rewritten, and no
    key is looked for elsewhere.
    """
    ensure_conf(spark)
    keys = _cols(unique_key)
    part = F.col(f"`{partition_by}`")
    touched = [r[0] for r in upserts.select(part).union(gone.select(part)).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(touched) > MAX_PARTITIONS:
        raise TooManyPartitions(f"the changes touch more than {MAX_PARTITIONS} partitions of {path}")
    touched = [v[0] for v in _order((v,) for v in touched)]
    if not touched:
        return UpsertResult(path, "changes", False, [], [], 0)
    if not path_exists(spark, path):
        write_table(upserts, path, partition_by)
        return UpsertResult(path, "changes", True, touched, [])
    target = spark.read.schema(upserts.schema).parquet(path).where(in_partitions([partition_by], [(v,) for v in touched]))
    # keys of the inserted rows too: a run that is repeated meets its own rows
    replaced = gone.select(*[F.col(f"`{k}`") for k in keys]).union(upserts.select(*[F.col(f"`{k}`") for k in keys]))
    new = target.join(replaced, keys, "left_anti").select(*[F.col(f"`{c}`") for c in upserts.columns]).unionByName(upserts)
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        alive = {r[0] for r in new.select(part).distinct().collect()}
        (balanced(new, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    finally:
        new.unpersist()
    emptied = [v for v in touched if v not in alive]
    _delete_partitions(spark, path, [partition_by], [(v,) for v in emptied])
    return UpsertResult(path, "changes", False, touched, emptied)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A catalog table whose rows lie in ``buckets`` files by hash of ``key``, sorted in each.

    Two such tables with equal bucket counts join on their keys without a shuffle. The rows are
    dealt by the same hash first, so each bucket is one file of one task.
    """
    (df.repartition(buckets, F.col(f"`{key}`")).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))


def file_counts(spark: SparkSession, path: str, partition_by: str | list[str]) -> DataFrame:
    """``directory, files, bytes`` of every partition directory (metadata only, listed by Spark's own file source)."""
    columns = _cols(partition_by)
    pattern = "((?:/[^/]+=[^/]*){%d})/[^/]+$" % len(columns)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    return (files.select(F.regexp_extract("path", pattern, 1).alias("directory"), "length")
            .where(F.col("directory").startswith(f"/{columns[0]}="))
            .groupBy("directory").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def compact(spark: SparkSession, path: str, partition_by: str | list[str], max_files: int = 4,
            target_file_bytes: int = 128 * 1024 * 1024, round_partitions: int = 10_000) -> list[str]:
    """K9: rewrite fragmented partitions into files of about ``target_file_bytes``.

    A partition is fragmented if it has more than ``max_files`` files and more than its bytes
    need. Its rows are dealt by hash to just as many tasks as it needs files, so a second call
    finds nothing to do. Any number of partitions is handled, ``round_partitions`` in one job.
    Returns the rewritten partition directories.
    """
    from urllib.parse import unquote

    columns = _cols(partition_by)
    ensure_conf(spark)
    need = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_file_bytes)).cast("int")
    done: set[str] = set()
    while True:
        chosen = (file_counts(spark, path, columns).withColumn("need", need)
                  .where((F.col("files") > max_files) & (F.col("files") > F.col("need"))).limit(round_partitions).collect())
        chosen = [r for r in chosen if r["directory"] not in done]   # a partition that stays fragmented is not tried again
        if not chosen:
            return sorted(d.strip("/") for d in done)
        done |= {r["directory"] for r in chosen}
        _compact_some(spark, path, columns, {tuple(unquote(x.split("=", 1)[1]) for x in r["directory"].strip("/").split("/")): r["need"] for r in chosen})


def _compact_some(spark: SparkSession, path: str, columns: list[str], plan: dict[tuple, int]) -> None:
    """Rewrite the partitions (directory values as text) into so many files each."""
    target = spark.read.parquet(path)
    dtypes = dict(target.dtypes)
    key = _partition_key([F.col(f"`{c}`") for c in columns])
    names = {"\x01".join(v): n for v, n in plan.items()}
    wanted = spark.createDataFrame(list(names.items()), "_key string, _need int")
    dealt = target.where(key.isin(list(names))).withColumn("_key", key).join(F.broadcast(wanted), "_key")
    plain = [F.col(f"`{c}`") for c, t in dtypes.items() if "map<" not in t and c not in columns]
    dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*plain), F.col("_need")))
    (dealt.repartition(sum(plan.values()), "_key", "_file")
     .select(*[F.col(f"`{c}`") for c in target.columns]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path))
