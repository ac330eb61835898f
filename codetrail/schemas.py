"""Source and output schemas, column orders and unique keys of the three models."""

from __future__ import annotations

from pyspark.sql import types as T

ADDRESS = T.BinaryType()   # 20 bytes
HASH = T.BinaryType()      # 32 bytes
WEI = T.DecimalType(38, 0)  # uint256 values that fit 38 digits; pass-through only

ACCESS_LIST = T.ArrayType(T.StructType([
    T.StructField("address", ADDRESS),
    T.StructField("storage_keys", T.ArrayType(T.BinaryType())),
]))

TRANSACTIONS = T.StructType([
    T.StructField("block_time", T.TimestampType(), False),
    T.StructField("block_date", T.DateType(), False),
    T.StructField("block_number", T.LongType(), False),
    T.StructField("value", WEI),
    T.StructField("gas_limit", T.LongType()),
    T.StructField("gas_price", WEI),
    T.StructField("gas_used", T.LongType()),
    T.StructField("max_fee_per_gas", WEI),
    T.StructField("max_priority_fee_per_gas", WEI),
    T.StructField("priority_fee_per_gas", WEI),
    T.StructField("nonce", T.LongType()),
    T.StructField("index", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("from", ADDRESS, False),
    T.StructField("to", ADDRESS),
    T.StructField("block_hash", HASH),
    T.StructField("hash", HASH, False),
    T.StructField("type", T.StringType()),
    T.StructField("access_list", ACCESS_LIST),
    T.StructField("chain_id", T.LongType()),
    T.StructField("fee_currency", ADDRESS),
    T.StructField("data", T.BinaryType()),
])

TRANSFERS = T.StructType([
    T.StructField("unique_key", T.StringType(), False),
    T.StructField("blockchain", T.StringType(), False),
    T.StructField("block_month", T.DateType()),
    T.StructField("block_date", T.DateType(), False),
    T.StructField("block_time", T.TimestampType(), False),
    T.StructField("block_number", T.LongType(), False),
    T.StructField("tx_hash", HASH, False),
    T.StructField("evt_index", T.LongType()),
    T.StructField("trace_address", T.ArrayType(T.LongType())),
    T.StructField("token_standard", T.StringType()),
    T.StructField("tx_from", ADDRESS),
    T.StructField("tx_to", ADDRESS),
    T.StructField("tx_index", T.LongType()),
    T.StructField("from", ADDRESS),
    T.StructField("to", ADDRESS),
    T.StructField("contract_address", ADDRESS),
    T.StructField("symbol", T.StringType()),
    T.StructField("amount_raw", WEI),
    T.StructField("amount", T.DoubleType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("amount_usd", T.DoubleType()),
    T.StructField("_updated_at", T.TimestampType()),
])

PRICES = T.StructType([
    T.StructField("blockchain", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("contract_address", ADDRESS, False),
    T.StructField("price", T.DoubleType()),
])

# Source columns carried through each model, in source order.
TX_PASSTHROUGH = [f.name for f in TRANSACTIONS.fields if f.name != "data"]
TRANSFER_PASSTHROUGH = [f.name for f in TRANSFERS.fields]

ATTRIBUTION_COLUMNS = ["has_builder_code", "multi_code", "builder_code", "builder_code2"]

# Output column order of transactions_attributed: hash moves to 4th place.
TX_ATTRIBUTED_COLUMNS = (
    ["block_time", "block_date", "block_number", "hash"]
    + [c for c in TX_PASSTHROUGH if c not in ("block_time", "block_date", "block_number", "hash")]
    + ATTRIBUTION_COLUMNS
)
TRANSFERS_ATTRIBUTED_COLUMNS = TRANSFER_PASSTHROUGH + ATTRIBUTION_COLUMNS
DAILY_METRIC_COLUMNS = [
    "day", "builder_code", "volume_usd", "tx_count", "token_transfers_tx", "unique_addresses", "chain_fees_usd",
]

# Unique keys (row identity) of the three models.
TX_KEY = ["hash"]
TRANSFER_KEY = ["unique_key"]
DAILY_KEY = ["day", "builder_code"]

# Partition columns chosen for the written tables.
TX_PARTITION = "block_date"
TRANSFER_PARTITION = "block_date"

# Output schemas: tables are always read back with these, so an empty table (a partitioned
# write of zero rows leaves no files) reads as empty instead of failing schema inference.
ATTRIBUTION_FIELDS = [
    T.StructField("has_builder_code", T.BooleanType()),
    T.StructField("multi_code", T.StringType()),
    T.StructField("builder_code", T.StringType()),
    T.StructField("builder_code2", T.StringType()),
]
_TX_FIELDS = {f.name: f for f in TRANSACTIONS.fields}
TX_ATTRIBUTED = T.StructType(
    [_TX_FIELDS[c] for c in TX_ATTRIBUTED_COLUMNS if c in _TX_FIELDS] + ATTRIBUTION_FIELDS)
TRANSFERS_ATTRIBUTED = T.StructType(list(TRANSFERS.fields) + ATTRIBUTION_FIELDS)
DAILY_METRIC = T.StructType([
    T.StructField("day", T.TimestampType()),
    T.StructField("builder_code", T.StringType()),
    T.StructField("volume_usd", T.DoubleType()),
    T.StructField("tx_count", T.LongType()),
    T.StructField("token_transfers_tx", T.LongType()),
    T.StructField("unique_addresses", T.LongType()),
    T.StructField("chain_fees_usd", T.DoubleType()),
])
