"""Spot-check counts, tagged unions, top-k reports and the date-co-keyed join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetrail.functions.literals import typed_lit


def row_count(df: DataFrame, label: str, label_col: str = "model") -> DataFrame:
    """One labelled global count."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias(label_col), "n")


def labelled_counts(named: dict[str, DataFrame], label_col: str = "model") -> DataFrame:
    """UNION ALL of labelled counts."""
    parts = [row_count(df, name, label_col) for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def flag_counts(df: DataFrame, flag: str = "has_builder_code") -> DataFrame:
    """Rows per flag value."""
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


def union_tagged(named: dict[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """Union of same-shaped relations (versions, chains) with a literal tag column."""
    parts = [df.select(F.lit(tag).alias(tag_col), *[F.col(f"`{c}`") for c in df.columns]) for tag, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_k(df: DataFrame, n: int, by: str, tie_break: list[str]) -> DataFrame:
    """ORDER BY ... LIMIT n (planned as TakeOrderedAndProject: a per-partition top-n,
    then a merge of n rows per partition -- never a global sort)."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie_break]).limit(n)


def code_totals(dm: DataFrame) -> DataFrame:
    """Per-code totals over the whole daily metric."""
    return dm.groupBy("builder_code").agg(
        F.sum("volume_usd").alias("volume_usd"),
        F.sum("tx_count").alias("tx_count"),
        F.sum("chain_fees_usd").alias("chain_fees_usd"),
    )


def transfers_with_tx(transfers: DataFrame, ta: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Inner join on (tx_hash = hash, block_date) with the time bound on *both* sides.

    A transfer lives in its transaction's block, so ``block_date`` is a co-key: it is a
    partition column on both tables, both scans prune to the bound, and the join keys carry it.
    """
    t = transfers.where(F.col("block_date").between(typed_lit(start), typed_lit(end))).alias("t")
    a = ta.where(F.col("block_date").between(typed_lit(start), typed_lit(end))).alias("a")
    return t.join(a, (F.col("t.tx_hash") == F.col("a.hash")) & (F.col("t.block_date") == F.col("a.block_date")),
                  "inner")


def spot_check(df: DataFrame, n: int = 10) -> DataFrame:
    """``SELECT * ... LIMIT n`` -- a few arbitrary rows for eyeballing a model.

    Planned as ``CollectLimit``: tasks stop after ``n`` rows, so the whole table is never scanned
    for it. The rows are unordered by design (use :func:`top_k` for a ranked report).
    """
    return df.limit(n)
