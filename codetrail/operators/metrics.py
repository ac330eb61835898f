"""Model 3: daily metrics per effective builder code.

Shape at scale: each side is aggregated on its own before any join (no fan-out), so the
joins at the end are between small (day, code) aggregates. The transaction table is scanned
once (:func:`tx_sets`). A single code may own a large share of rows:
SUM is absorbed by map-side partial aggregation, and the exact distinct counts are
planned by Catalyst as an ``Expand`` whose first shuffle is keyed by (day, code, value),
which spreads a hot code over all tasks.

Fees are summed per (day, code, priced token) first and multiplied by the day's price
after. This replaces the row-level join of every fee row against the price table -- whose
native-token key would put most rows of a day in one task -- with a join of two small
aggregates. ``sum(fee_i * p) = p * sum(fee_i)`` because the price is constant per
(day, token); only the floating-point summation order changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetrail.functions import fees as feefn
from codetrail.functions.trailer import effective_code
from codetrail.functions.windows import Floors, Lookback
from codetrail.session import ensure_conf

KEY = ["day", "builder_code"]


def _day(ts: str) -> F.Column:
    """DATE_TRUNC('day', ts): a midnight timestamp, not a date."""
    return F.date_trunc("day", F.col(ts))


def attributed_transfers(tra: DataFrame, floors: Floors = Floors(), window: Lookback | None = None) -> DataFrame:
    """Attributed transfer rows with day and effective code."""
    ensure_conf(tra.sparkSession)
    df = tra.where(F.col("builder_code").isNotNull() & floors.date_pred())
    if window is not None:
        df = df.where(window.date_pred())
    return df.select(
        _day("block_time").alias("day"),
        F.col("tx_hash"),
        effective_code("builder_code", "builder_code2").alias("builder_code"),
        F.col("amount_usd"),
    )


def transfer_metrics(at: DataFrame) -> DataFrame:
    """SUM(amount_usd) (NULLs ignored) and COUNT(DISTINCT tx_hash) per (day, code)."""
    return at.groupBy(*KEY).agg(
        F.sum("amount_usd").alias("volume_usd"),
        F.count_distinct("tx_hash").alias("token_transfers_tx"),
    )


def attributed_txs(ta: DataFrame, floors: Floors = Floors(), window: Lookback | None = None) -> DataFrame:
    """Tagged transactions with day, effective code, sender and fee inputs."""
    ensure_conf(ta.sparkSession)
    df = ta.where(F.col("has_builder_code") & floors.date_pred())
    if window is not None:
        df = df.where(window.date_pred())
    return df.select(
        _day("block_time").alias("day"),
        F.col("hash").alias("tx_hash"),
        effective_code("builder_code", "builder_code2").alias("builder_code"),
        F.col("from").alias("user_address"),
        F.col("gas_used"),
        F.col("gas_price"),
        F.col("fee_currency"),
    )


def tx_metrics(atx: DataFrame) -> DataFrame:
    """Distinct transactions and distinct senders per (day, code)."""
    return atx.groupBy(*KEY).agg(
        F.count_distinct("tx_hash").alias("tx_count"),
        F.count_distinct("user_address").alias("unique_addresses"),
    )


def tx_fees(atx: DataFrame, mapping=None) -> DataFrame:
    """Fee in gas-token units and the address whose price converts it to USD."""
    return atx.select(
        "day",
        "builder_code",
        "tx_hash",
        feefn.fee_token_amount().alias("fee_token_amount"),
        feefn.price_address(mapping=mapping).alias("price_address"),
    )


def fee_totals(fees: DataFrame) -> DataFrame:
    """Fees summed per (day, code, priced token) -- map-side combined before the shuffle."""
    return fees.groupBy("day", "builder_code", "price_address").agg(
        F.sum("fee_token_amount").alias("fee_token_amount")
    )


def used_prices(prices: DataFrame, used: DataFrame, chain: str = "celo", floors: Floors = Floors(),
                window: Lookback | None = None) -> DataFrame:
    """Price rows of one chain, above the floor, whose token is actually used.

    ``contract_address IN (SELECT DISTINCT price_address ...)`` as a left semi join; the
    distinct gas tokens are few, and Catalyst/AQE pick a broadcast semi join from sizes
    measured at run time.
    """
    ensure_conf(prices.sparkSession)
    df = prices.where((F.col("blockchain") == F.lit(chain)) & floors.price_pred())
    if window is not None:
        df = df.where(window.ts_pred("timestamp"))
    return df.join(used.select(F.col("price_address").alias("contract_address")), "contract_address", "left_semi")


def token_prices(prices: DataFrame, used: DataFrame, chain: str = "celo", floors: Floors = Floors(),
                 window: Lookback | None = None) -> DataFrame:
    """C11: mean price per (day, token) for tokens that are actually used."""
    df = used_prices(prices, used, chain, floors, window)
    return df.groupBy(_day("timestamp").alias("day"), F.col("contract_address")).agg(F.avg("price").alias("price"))


def daily_prices(prices: DataFrame, chain: str = "celo", floors: Floors = Floors(),
                 window: Lookback | None = None) -> DataFrame:
    """Mean price per (day, token) of one chain, without the used-token semi join.

    Used by :func:`daily_metrics`: the left join of fee totals on (day, token) keeps only
    used tokens anyway, so the averages it picks are the same as with the semi join, and
    the transaction side is not scanned a second time just to list the used tokens.
    """
    ensure_conf(prices.sparkSession)
    df = prices.where((F.col("blockchain") == F.lit(chain)) & floors.price_pred())
    if window is not None:
        df = df.where(window.ts_pred("timestamp"))
    return df.groupBy(_day("timestamp").alias("day"), F.col("contract_address")).agg(F.avg("price").alias("price"))


def fee_metrics(totals: DataFrame, prices: DataFrame) -> DataFrame:
    """Fees in USD per (day, code); a missing price counts as 0."""
    p = prices.withColumnRenamed("contract_address", "price_address")
    joined = totals.join(p, ["day", "price_address"], "left")
    return joined.groupBy(*KEY).agg(
        F.sum(F.col("fee_token_amount") * F.coalesce(F.col("price"), F.lit(0.0))).alias("chain_fees_usd")
    )


def tx_sets(atx: DataFrame, mapping=None) -> DataFrame:
    """The distinct hashes, senders and priced tokens of every (day, code) in one pass over the transactions.

    GROUPING SETS: each transaction becomes three narrow rows keyed by (day, code, one value), so one
    scan and one shuffle serve both distinct counts and the fee totals, and a hot code is spread by
    value. ``part`` names the set; ``fee_token_amount`` is the sum of the set's rows.
    """
    rows = atx.select(*KEY, "tx_hash", "user_address", feefn.price_address(mapping=mapping).alias("price_address"),
                      feefn.fee_token_amount().alias("fee_token_amount"))
    values = ["tx_hash", "user_address", "price_address"]
    sets = rows.groupingSets([[*KEY, v] for v in values], *KEY, *values).agg(
        F.grouping_id().alias("gid"), F.sum("fee_token_amount").alias("fee_token_amount"))
    # grouping_id has a bit for each column that a set leaves out, the last column in the lowest bit
    part = F.when(F.col("gid") == 3, "tx_hash").when(F.col("gid") == 5, "user_address").otherwise("price_address")
    return sets.select(*KEY, *values, part.alias("part"), "fee_token_amount")


def tx_fee_metrics(sets: DataFrame, prices: DataFrame) -> DataFrame:
    """C9 and C12 together, from :func:`tx_sets`: counts and fees in USD per (day, code)."""
    is_part = lambda p: F.col("part") == p
    small = sets.groupBy(*KEY, F.when(is_part("price_address"), F.col("price_address")).alias("price_address")).agg(
        F.count(F.when(is_part("tx_hash"), F.col("tx_hash"))).alias("tx_count"),
        F.count(F.when(is_part("user_address"), F.col("user_address"))).alias("unique_addresses"),
        F.sum(F.when(is_part("price_address"), F.col("fee_token_amount"))).alias("fee_token_amount"))
    p = prices.withColumnRenamed("contract_address", "price_address")
    return small.join(p, ["day", "price_address"], "left").groupBy(*KEY).agg(
        F.sum("tx_count").alias("tx_count"), F.sum("unique_addresses").alias("unique_addresses"),
        F.sum(F.col("fee_token_amount") * F.coalesce(F.col("price"), F.lit(0.0))).alias("chain_fees_usd"))


def daily_metrics(tra: DataFrame, ta: DataFrame, prices: DataFrame, chain: str = "celo", floors: Floors = Floors(),
                  window: Lookback | None = None, mapping=None) -> DataFrame:
    """C13 ``buildercode_daily_metric``: tx metrics LEFT JOIN transfer metrics LEFT JOIN fee metrics.

    The transaction side drives: a (day, code) seen only in transfers is dropped, one without
    transfers gets volume 0 and 0 transfer transactions. The transaction table is scanned once:
    its counts and its fees come out of one aggregation.
    """
    sets = tx_sets(attributed_txs(ta, floors, window), mapping)
    tm = transfer_metrics(attributed_transfers(tra, floors, window))
    out = tx_fee_metrics(sets, daily_prices(prices, chain, floors, window)).join(tm, KEY, "left")
    return out.select(
        "day",
        "builder_code",
        F.coalesce(F.col("volume_usd"), F.lit(0.0)).alias("volume_usd"),
        "tx_count",
        F.coalesce(F.col("token_transfers_tx"), F.lit(0)).alias("token_transfers_tx"),
        "unique_addresses",
        F.coalesce(F.col("chain_fees_usd"), F.lit(0.0)).alias("chain_fees_usd"),
    )
