"""Daily metric from partial aggregates that merge: rows that arrive are aggregated once and never read again.

Exact distinct counts do not add up, so what is kept of a day is the distinct values themselves,
narrow and without repeats inside a batch:

* transactions: (day, code, part, value, fee) of :func:`metrics.tx_sets`, where ``part`` says whether
  the value is a hash, a sender or a priced token;
* transfers: (day, tx_hash, amount_usd), summed per transaction and *not yet attributed*, so a transfer
  may arrive before its transaction or after it.

Each batch of arrivals is appended once (its retry is skipped, see :func:`upsert.append_once`), and the
metric of some days unions their partials: distinct values by grouping, sums by adding. A batch is
partitioned by day, so only the directories of the asked days are read, never the source tables.

Every source row must be in exactly one batch, and a transfer must lie on its transaction's day (they
share a block). With a repeated transaction hash the transfer of the hash counts once for each code,
where the join model counts it for each row; the quality checks assert that hashes are unique.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from codetrail.functions.literals import isin
from codetrail.functions.windows import Floors
from codetrail.operators import attribution, metrics, upsert
from codetrail.session import path_exists

TX_PARTS = T.StructType([
    T.StructField("builder_code", T.StringType()), T.StructField("part", T.StringType()), T.StructField("value", T.BinaryType()),
    T.StructField("fee_token_amount", T.DoubleType()), T.StructField("day", T.DateType())])
TRANSFER_PARTS = T.StructType([
    T.StructField("tx_hash", T.BinaryType()), T.StructField("amount_usd", T.DoubleType()), T.StructField("day", T.DateType())])


def _value(part: str) -> F.Column:
    return F.when(F.col("part") == part, F.col("value"))


def tx_parts(ta: DataFrame, floors: Floors = Floors(), mapping=None) -> DataFrame:
    """Partials of attributed transactions."""
    sets = metrics.tx_sets(metrics.attributed_txs(ta, floors), mapping)
    return sets.select("builder_code", "part", F.coalesce("tx_hash", "user_address", "price_address").alias("value"),
                       F.when(F.col("part") == "price_address", F.col("fee_token_amount")).alias("fee_token_amount"),
                       F.to_date("day").alias("day"))


def transfer_parts(transfers: DataFrame, chain: str = "celo", floors: Floors = Floors()) -> DataFrame:
    """Partials of transfers as they come from the source."""
    rows = attribution.select_transfers(transfers, chain, floors)
    return rows.groupBy("tx_hash", F.to_date("block_time").alias("day")).agg(F.sum("amount_usd").alias("amount_usd")).select(
        "tx_hash", "amount_usd", "day")


def add_transactions(spark: SparkSession, transactions: DataFrame, root: str, batch_id: str, floors: Floors = Floors(),
                     mapping=None) -> upsert.UpsertResult:
    """Aggregate newly arrived transactions into their days' partials; a batch that was added before is skipped."""
    parts = tx_parts(attribution.attribute_transactions(transactions, floors), floors, mapping)
    return upsert.append_once(spark, parts, f"{root}/tx_parts", batch_id, "day")


def add_transfers(spark: SparkSession, transfers: DataFrame, root: str, batch_id: str, chain: str = "celo",
                  floors: Floors = Floors()) -> upsert.UpsertResult:
    """The same for newly arrived transfers, whether their transactions are there or not."""
    return upsert.append_once(spark, transfer_parts(transfers, chain, floors), f"{root}/transfer_parts", batch_id, "day")


def _read(spark: SparkSession, path: str, schema: T.StructType, days: list[dt.date] | None) -> DataFrame:
    df = upsert.read_appended(spark, path, schema) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return df if days is None else df.where(isin(F.col("day"), days))


def daily_from_parts(spark: SparkSession, root: str, prices: DataFrame, days: list[dt.date] | None = None, chain: str = "celo",
                     floors: Floors = Floors()) -> DataFrame:
    """C13 of the given days (all: None) from the partials: the rows of :func:`metrics.daily_metrics`."""
    parts = _read(spark, f"{root}/tx_parts", TX_PARTS, days)
    values = parts.groupBy("day", "builder_code", "part", "value").agg(F.sum("fee_token_amount").alias("fee_token_amount"))
    values = values.withColumn("day", F.col("day").cast("timestamp"))
    sets = values.select("day", "builder_code", "part", "fee_token_amount",
                         *[_value(p).alias(p) for p in ("tx_hash", "user_address", "price_address")])
    txm = metrics.tx_fee_metrics(sets, metrics.daily_prices(prices, chain, floors))

    hashes = parts.where((F.col("part") == "tx_hash") & F.col("builder_code").isNotNull()).select(
        "day", "builder_code", F.col("value").alias("tx_hash")).distinct()
    moved = _read(spark, f"{root}/transfer_parts", TRANSFER_PARTS, days).groupBy("day", "tx_hash").agg(F.sum("amount_usd").alias("amount_usd"))
    volume = (hashes.join(moved, ["day", "tx_hash"]).groupBy("day", "builder_code")
              .agg(F.sum("amount_usd").alias("volume_usd"), F.count(F.lit(1)).alias("token_transfers_tx"))
              .withColumn("day", F.col("day").cast("timestamp")))
    return txm.join(volume, metrics.KEY, "left").select(
        "day", "builder_code", F.coalesce("volume_usd", F.lit(0.0)).alias("volume_usd"), "tx_count",
        F.coalesce("token_transfers_tx", F.lit(0)).alias("token_transfers_tx"), "unique_addresses",
        F.coalesce("chain_fees_usd", F.lit(0.0)).alias("chain_fees_usd"))
