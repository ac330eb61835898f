"""Filter interaction audit: what every order of five text filters keeps, removes and leaves redundant.

1. Every row gets a mask of the filters that it fails. Four of them look at the row alone. The
   fifth, "copy of a smaller id's text", needs the least id of each text: digests of the texts are
   combined map-side, and a row passes if (digest, id) is the least one. That join is keyed by
   both, so a text that a third of all rows share is spread by its ids.
2. Rows are counted by (part, mask) with their labels: at most 32 mask cells for each part.
3. Each cell folds its mask across the array of all orders with ``aggregate`` and ``transform``:
   600 structs (120 orders of 5 steps) weighted with the cell's counts. A part's cells are merged
   by elementwise sums of these arrays; the Shapley sums are read off the merged array.

Everything is DataFrame and SQL functions; only the constant array of orders is broadcast (as a
literal of the plan), and nothing reaches the driver.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from .common import written

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: its letter -> whether the text fails. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, good, toxic`` of every row; bit i of the mask is set if the row fails filter i.

    Rows without an id have no smaller id and no label. Of repeated label rows the larger value counts.
    """
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(F.col(text_col).cast("string")).values())]
    own = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).cast("byte").alias("own"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).alias("digest"))
    own = written(own, "audit-rows")
    least = written(own.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")), "audit-least")
    first = least.withColumn("first", F.lit(True))
    # written on both sides of each join: plain shuffles, whose skewed partitions Spark splits at run time
    known = own.where("id is not null").join(first, ["digest", "id"], "left").select(
        "id", "part", F.when(F.col("first"), F.col("own")).otherwise(F.col("own") + F.lit(16)).cast("byte").alias("mask"))
    known = written(known, "audit-masks")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    marked = known.join(marks, "id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return marked.unionByName(own.where("id is null").select("part", F.col("own").alias("mask"), F.lit(0).alias("good"), F.lit(0).alias("toxic")))


def orders() -> Column:
    """All orders of the filters, as arrays of filter numbers."""
    return F.array(*[F.array(*[F.lit(i) for i in p]) for p in permutations(range(len(FILTERS)))])


MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def folded(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """One cell's 600 structs: its counts, weighted by what each step of each order does to the mask."""
    mask = mask.cast("int")
    none = F.lit(0).cast("long")

    def one_order(order: Column) -> Column:
        def step(state: Column, filter_no: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1), filter_no)
            fails = mask.bitwiseAND(bit) != 0
            alive = state["alive"]
            goes = alive & fails
            out = F.struct(
                F.when(alive & ~fails, n).otherwise(none).alias("kept"), F.when(goes, n).otherwise(none).alias("removed"),
                F.when(fails & ~alive, n).otherwise(none).alias("redundant"), F.when(mask == bit, n).otherwise(none).alias("unique_fails"),
                F.when(goes, good).otherwise(none).alias("good_lost"), F.when(goes, toxic).otherwise(none).alias("toxic_lost"))
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["out"], F.array(out)).alias("out"))

        empty = F.array().cast("array<struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">>")
        return F.aggregate(order, F.struct(F.lit(True).alias("alive"), empty.alias("out")), step, lambda s: s["out"])

    return F.flatten(F.transform(orders(), one_order))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step: ``part, filter_order, step, filter`` and the counts.

    ``kept``: rows left after the step; ``removed``: rows that it removes; ``redundant``: rows that
    fail its filter and were removed before; ``unique_fails``: rows that fail its filter alone;
    ``good_lost``, ``toxic_lost``: removed rows labelled so; ``shapley``: the rows that its filter
    removes, summed over all orders. A null part counts as the empty string, a null or empty text
    as a text without words; repeated rows count each; an empty table has no parts and gives no
    rows. Texts of any length are read whole; other columns are ignored.
    """
    cells = masks(docs, labels, id_col, text_col, part_col).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))
    cells = written(cells, "audit-cells")
    each = cells.select("part", folded(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps"))
    zero = F.transform(F.flatten(orders()), lambda _: F.struct(*[F.lit(0).cast("long").alias(m) for m in MEASURES]))
    # at most 2**5 arrays stand together in a part
    merged = each.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", F.aggregate(
        "cells", zero, lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(*[(x[m] + y[m]).alias(m) for m in MEASURES]))).alias("steps"))
    numbered = F.zip_with(F.flatten(orders()), F.col("steps"), lambda i, s: F.named_struct(F.lit("filter_no"), i, F.lit("removed"), s["removed"]))
    def removed_by(i: int) -> Column:
        return F.aggregate(F.filter(numbered, lambda s: s["filter_no"] == i), F.lit(0).cast("long"), lambda a, s: a + s["removed"])

    shapley = F.array(*[removed_by(i) for i in range(len(FILTERS))])
    names = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = merged.select("part", shapley.alias("shapley"), F.posexplode("steps").alias("pos", "s"))
    order = names[F.floor(F.col("pos") / len(FILTERS)).cast("int")]
    step = (F.col("pos") % len(FILTERS) + 1).cast("int")
    letter = F.substring(order, step, F.lit(1))
    return rows.select("part", order.alias("filter_order"), step.alias("step"), letter.alias("filter"),
                       *[F.col(f"s.{m}").alias(m) for m in MEASURES], F.col("shapley")[F.instr(F.lit(FILTERS), letter) - 1].alias("shapley"))
