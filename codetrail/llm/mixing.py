"""Mixing sources to target weights: a budgeted cut of each source in hash-random order.

Every document gets a pseudo-random key, the MD5 of the seed and its id, so a rerun or a retry
draws the same mix. Keys are range-partitioned inside each source: the key range is cut into
equal buckets, and since the keys are uniform every bucket has about ``bucket_rows`` rows of the
whole table, however large one source is. Prefix sums of the sizes are distributed: totals by
(source, bucket), prefix sums of those in two levels, and a running sum inside each bucket. A
document is taken where its prefix sum is below the budget; a budget beyond the source's size
repeats the source in whole epochs first.

DataFrame operations only. The driver sees row counts and, for each round of water-filling, three
sums.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import positional, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_ROWS = 5_000
SUPER = 1024
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of white-space separated words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, buckets: int) -> DataFrame:
    source = F.col(source_col).cast("string")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return docs.withColumns({
        "__mix_size": words(F.col(text_col)), "__mix_source": F.coalesce(source, F.lit("")), "__mix_null": source.isNull(),
        "__mix_key": key, "__mix_tie": F.xxhash64(F.col(text_col)),
        "__mix_bucket": F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long")})


def _ranks(sources: DataFrame) -> DataFrame:
    """Adds ``rank``: the place of each source by code point, null last (distributed: sorted runs and their offsets)."""
    placed = written(sources.repartitionByRange("__mix_null", "__mix_source").sortWithinPartitions("__mix_null", "__mix_source")
                     .withColumn("__run", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "mix-ranks")
    runs = placed.groupBy("__run").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("__run", before.alias("before"))  # one row for each partition
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(runs, "__run").withColumn("rank", F.col("before") + within).drop("__run", "__at", "before")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``(__mix_source, __mix_null, source_size)``.

    ``share`` of all sizes is divided by weight; a target stops at ``max_epochs`` times its
    source's size, and the excess is shared again by weight until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(_ranks(sources).withColumn("weight", weight), "mix-sources")
    cap = F.col("source_size") * max_epochs
    level, capped = 0.0, -1
    while True:
        over = (F.col("weight") * F.lit(level) > cap) if capped >= 0 else F.lit(False)
        all_, held, n, rest = ranked.agg(
            F.sum("source_size"), F.sum(F.when(over, cap)), F.count(F.when(over, 1)), F.sum(F.when(~over, F.col("weight")))).first()
        if n <= capped or not rest:  # no further source stops
            break
        capped, level = n, float(Fraction(all_ or 0) * Fraction(share) - (held or 0)) / rest
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def _plan(docs: DataFrame, id_col, text_col, source_col, weights, max_epochs, share, seed, bucket_rows):
    """(keyed documents, one row for each (source, bucket) with its prefix sum and its source's budget)."""
    buckets = max(1, math.ceil(docs.count() / bucket_rows))
    keyed = _keyed(docs, id_col, text_col, source_col, seed, buckets)
    src = ["__mix_source", "__mix_null"]
    cells = written(keyed.groupBy(*src, "__mix_bucket").agg(F.sum("__mix_size").alias("n"))
                    .withColumn("__super", F.expr(f"__mix_bucket div {SUPER}")), "mix-cells")
    aims = targets(cells.groupBy(*src).agg(F.sum("n").alias("source_size")), weights, max_epochs, share)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    supers = cells.groupBy(*src, "__super").agg(F.sum("n").alias("n"))
    supers = supers.select(*src, "__super", before(Window.partitionBy(*src).orderBy("__super")).alias("upper"))
    inner = cells.withColumn("lower", before(Window.partitionBy(*src, "__super").orderBy("__mix_bucket")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("__mix_budget div source_size")).otherwise(F.lit(0))
    plan = (inner.join(supers, [*src, "__super"]).join(aims, src).withColumn("__mix_budget", budget)
            .withColumn("__mix_epochs", epochs)
            .select(*src, "__mix_bucket", (F.col("upper") + F.col("lower")).alias("__mix_offset"), "source_size", "target", "__mix_epochs",
                    (F.col("__mix_budget") - F.col("__mix_epochs") * F.col("source_size")).alias("__mix_rest")))
    return keyed, written(plan, "mix-plan")


def _taken(keyed: DataFrame, plan: DataFrame, id_col: str) -> DataFrame:
    cell = ["__mix_source", "__mix_null", "__mix_bucket"]
    running = Window.partitionBy(*cell).orderBy("__mix_key", F.col(id_col).asc_nulls_last(), "__mix_tie")
    before = F.coalesce(F.sum("__mix_size").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = plan.withColumnsRenamed({"source_size": "__mix_total", "target": "__mix_target"})
    out = keyed.withColumn("__mix_before", before).join(plan, cell)
    part = F.greatest(F.lit(0), F.least(F.col("__mix_size"), F.col("__mix_rest") - F.col("__mix_offset") - F.col("__mix_before")))
    return out.withColumns({"size": F.col("__mix_size"), "source_size": F.col("__mix_total"), "target": F.col("__mix_target"),
                            "taken": (F.col("__mix_epochs") * F.col("__mix_size") + part).cast("long")})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, share: float = 1.0, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """How many words of each row the mix takes: ``<id_col>, size, source_size, target, taken``.

    Size is the number of white-space separated words (null text: 0). Sources in code point order,
    null last, weigh ``weights`` in turn. A source's taken words add up to its target, rounded;
    the document at the cut is taken in part, and a document at most ``max_epochs`` times. Every
    row gives one row; rows of equal id and text are interchangeable; an empty table gives none;
    other columns are ignored.
    """
    keep = docs.select(F.col(id_col).alias("__mix_id"), F.col(text_col).cast("string").alias("__mix_text"), F.col(source_col).alias("__mix_src"))
    keyed, plan = _plan(keep, "__mix_id", "__mix_text", "__mix_src", weights, max_epochs, share, seed, bucket_rows)
    return _taken(keyed.drop("__mix_text", "__mix_src"), plan, "__mix_id").select(
        F.col("__mix_id").alias(id_col), "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS,
                  max_epochs: int = MAX_EPOCHS, share: float = 1.0, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows that the mix takes (``taken`` above 0) with all their columns and those of :func:`mix`.

    Columns of ``docs`` named like a result column are replaced by it.
    """
    own = ["size", "source_size", "target", "taken"]
    docs = docs.drop(*own)
    plain, names = positional(docs, __mix_id=id_col, __mix_text=text_col, __mix_src=source_col)
    keyed, plan = _plan(plain, "__mix_id", "__mix_text", "__mix_src", weights, max_epochs, share, seed, bucket_rows)
    return _taken(keyed, plan, "__mix_id").where("taken > 0").select(*names, *own).toDF(*docs.columns, *own)
