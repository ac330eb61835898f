"""Model inputs derived with Spark from the driver's ``events`` table.

The reference ships no data, so ``transactions``, ``transfers`` and ``prices`` are
derived deterministically from ``events`` (one transaction per event, 0-3 transfers per
event, two price rows per day and token). The rules exercise every branch of the trailer
decoder, the chain filter, the fee-token map and missing prices. Work grows with
``events``: every operator below is a projection, a generator or a small distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetrail import schemas
from codetrail.functions import fees
from codetrail.functions.trailer import MARKER_HEX
from codetrail.session import use_utc

# Fixed values of the derivation rules (shared with the SQL oracle).
TRANSFER_SELECTOR_HEX = "a9059cbb"
CHAIN = "celo"
OTHER_CHAIN = "other"
PRICED_DIRECT = "ab" * 20     # fee token priced as itself
UNPRICED = "cd" * 20          # fee token without any price row
UNUSED_PRICED = "ef" * 20     # priced token nobody pays fees in
CHAIN_ID = 42220
TRAILER_CASES = 11
FEE_CASES = 6
TRANSFER_FANOUT = 4           # event i has (event_id % 4) transfers
OTHER_CHAIN_EVERY = 5


def _sha_hex(prefix: str, col: Column) -> Column:
    return F.sha2(F.concat(F.lit(prefix), col.cast("string")), 256)


def _address(prefix: str, col: Column) -> Column:
    return F.unhex(F.substring(_sha_hex(prefix, col), 1, 40))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
    )


#: Events of one task of the derivation.
EVENTS_PER_TASK, LEAST_EVENTS_PER_TASK = 250_000, 20_000


def dealt(spark: SparkSession, rows: DataFrame, n_events: int) -> DataFrame:
    """Events, still narrow, dealt over tasks by their day and sorted by it.

    A table of few, well compressed files is read by few tasks, and one that holds all days sorts its wide
    rows by day before it writes them; here the wide rows come out of each task in the order they are written.
    """
    tasks = max(-(-n_events // EVENTS_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-n_events // LEAST_EVENTS_PER_TASK)), 1)
    by_day = rows.withColumn("block_date", F.to_date("ts"))
    return by_day.repartitionByRange(tasks, "block_date", "event_id").sortWithinPartitions("block_date")


def calldata_hex(event_id: Column, user_id: Column) -> Column:
    """Hex text of the calldata for an event, by case k = event_id % 11."""
    k = event_id % TRAILER_CASES
    u20 = (user_id % 20).cast("string")
    code = (
        F.when(k.isin(0, 2, 3), F.concat(F.lit("app"), u20))
        .when(k == 1, F.concat(F.lit("minipay,app_"), u20))
        .when(k == 8, F.concat(F.lit(",tail"), (user_id % 3).cast("string")))
        .when(k == 9, F.lit("a,b,c"))
    )
    code_hex = F.lower(F.hex(F.encode(code, "UTF-8")))
    ll = F.lower(F.lpad(F.hex(F.octet_length(F.encode(code, "UTF-8"))), 2, "0"))
    p = F.lit(TRANSFER_SELECTOR_HEX)
    m = F.lit(MARKER_HEX)
    # what follows the code; the code's own text is built once (generated code over 8,000 bytes is never compiled)
    end = (
        F.when(k.isin(0, 1, 8, 9), F.concat(F.lit("00"), m))
        .when(k == 2, F.lit("00ff" + MARKER_HEX[2:]))
        .when(k == 3, F.concat(F.lit("01"), m))
    )
    return (
        F.when(k.isin(0, 1, 2, 3, 8, 9), F.concat(p, code_hex, ll, end))
        .when(k == 4, F.concat(p, F.lit("0000"), m))
        .when(k == 5, F.concat(F.lit("0000"), m))
        .when(k == 6, F.concat(F.lit("61ff00"), m))
        .when(k == 10, F.concat(p, F.lit("00" * 28)))
    )


def fee_currency_hex(user_id: Column) -> Column:
    c = user_id % FEE_CASES
    return (
        F.when(c == 1, F.lit(fees.ZERO_ADDRESS))
        .when(c == 2, F.lit(fees.USDC_ADAPTER))
        .when(c == 3, F.lit(fees.USDT_ADAPTER))
        .when(c == 4, F.lit(PRICED_DIRECT))
        .when(c == 5, F.lit(UNPRICED))
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event, typed as ``schemas.TRANSACTIONS``."""
    ev = load_events(spark, sf_dir)
    ev = dealt(spark, ev, ev.count())
    eid, uid = F.col("event_id"), F.col("user_id")
    gas_price = (F.lit(25_000_000_000) + (eid % 7) * F.lit(1_000_000_000)).cast(schemas.WEI)
    gwei = F.lit(1_000_000_000).cast(schemas.WEI)
    df = ev.select(
        F.col("ts").alias("block_time"),
        F.col("block_date"),
        eid.alias("block_number"),
        F.round(F.col("value") * 100).cast(schemas.WEI).alias("value"),
        F.lit(200_000).cast("long").alias("gas_limit"),
        gas_price.alias("gas_price"),
        (F.lit(21_000) + eid % 100_000).cast("long").alias("gas_used"),
        (gas_price + gwei).cast(schemas.WEI).alias("max_fee_per_gas"),
        gwei.alias("max_priority_fee_per_gas"),
        gwei.alias("priority_fee_per_gas"),
        (eid % 1000).alias("nonce"),
        (eid % 50).alias("index"),
        (F.col("event_type") != F.lit("error")).alias("success"),
        _address("user-", uid).alias("from"),
        _address("to-", F.col("event_type")).alias("to"),
        F.unhex(_sha_hex("block-", eid)).alias("block_hash"),
        F.unhex(_sha_hex("tx-", eid)).alias("hash"),
        F.when(eid % 3 == 0, F.lit("legacy")).otherwise(F.lit("eip1559")).alias("type"),
        F.lit(None).cast(schemas.ACCESS_LIST).alias("access_list"),
        F.lit(CHAIN_ID).cast("long").alias("chain_id"),
        F.unhex(fee_currency_hex(uid)).alias("fee_currency"),
        F.unhex(calldata_hex(eid, uid)).alias("data"),
    )
    return df


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event x {0, 1, 2} kept where i < event_id % 4, typed as ``schemas.TRANSFERS``."""
    ev = load_events(spark, sf_dir)
    eid, uid = F.col("event_id"), F.col("user_id")
    ex = ev.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i")).where(
        F.col("i") < eid % TRANSFER_FANOUT
    )
    ex = dealt(spark, ex, ev.count())
    i = F.col("i")
    amount = F.col("value") * (i + 1)
    contract = (
        F.when(i == 0, F.lit(fees.USDC_TOKEN)).when(i == 1, F.lit(fees.USDT_TOKEN)).otherwise(F.lit(fees.NATIVE_TOKEN))
    )
    return ex.select(
        _sha_hex("tr-", F.concat_ws("-", eid.cast("string"), i.cast("string"))).alias("unique_key"),
        F.when((i == 1) & (eid % OTHER_CHAIN_EVERY == 0), F.lit(OTHER_CHAIN)).otherwise(F.lit(CHAIN)).alias("blockchain"),
        F.trunc("block_date", "month").alias("block_month"),
        F.col("block_date"),
        F.col("ts").alias("block_time"),
        eid.alias("block_number"),
        F.unhex(_sha_hex("tx-", eid)).alias("tx_hash"),
        i.cast("long").alias("evt_index"),
        F.lit(None).cast("array<bigint>").alias("trace_address"),
        F.lit("erc20").alias("token_standard"),
        _address("user-", uid).alias("tx_from"),
        _address("to-", F.col("event_type")).alias("tx_to"),
        (eid % 50).alias("tx_index"),
        _address("src-", F.concat_ws("-", uid.cast("string"), i.cast("string"))).alias("from"),
        _address("dst-", eid % 97).alias("to"),
        F.unhex(contract).alias("contract_address"),
        F.when(i == 0, F.lit("USDC")).when(i == 1, F.lit("USDT")).otherwise(F.lit("CELO")).alias("symbol"),
        F.round(amount * 100).cast(schemas.WEI).alias("amount_raw"),
        amount.alias("amount"),
        F.lit(1.0).alias("price_usd"),
        F.when(i == 2, F.lit(None).cast("double")).otherwise(F.round(amount, 2)).alias("amount_usd"),
        F.col("ts").alias("_updated_at"),
    )


# Priced tokens of the derived price table, by offset o
# (price = 0.5 + 0.25 * day_of_month + o; the USDT row is missing when day_of_month % 3 = 0).
PRICED_TOKENS = [
    (0, fees.NATIVE_TOKEN),
    (1, fees.USDC_TOKEN),
    (2, fees.USDT_TOKEN),
    (3, PRICED_DIRECT),
    (4, UNUSED_PRICED),
]


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event days x priced tokens, two rows per (day, token) at price -/+ 0.25
    (00:00 and 12:00), plus one row of another chain per day. Typed as ``schemas.PRICES``."""
    ev = load_events(spark, sf_dir)
    days = ev.select(F.to_date("ts").alias("d")).distinct()
    tokens = F.array(*[
        F.struct(F.lit(o).alias("o"), F.lit(a).alias("addr"), F.lit(CHAIN).alias("chain")) for o, a in PRICED_TOKENS
    ], F.struct(F.lit(100).alias("o"), F.lit(fees.NATIVE_TOKEN).alias("addr"), F.lit(OTHER_CHAIN).alias("chain")))
    sides = F.array(
        F.struct(F.lit(-0.25).alias("delta"), F.lit(0).alias("hour")),
        F.struct(F.lit(0.25).alias("delta"), F.lit(12).alias("hour")),
    )
    x = days.select("d", F.explode(tokens).alias("t")).select("d", "t.*")
    x = x.where(~((F.col("addr") == F.lit(fees.USDT_TOKEN)) & (F.dayofmonth("d") % 3 == 0)))
    x = x.select("*", F.explode(sides).alias("s")).select("d", "o", "addr", "chain", "s.*")
    base = F.lit(0.5) + F.lit(0.25) * F.dayofmonth("d") + F.col("o")
    return x.select(
        F.col("chain").alias("blockchain"),
        (F.col("d").cast("timestamp") + F.make_interval(hours=F.col("hour"))).alias("timestamp"),
        F.unhex(F.col("addr")).alias("contract_address"),
        (base + F.col("delta")).alias("price"),
    )


# ---------------------------------------------------------------------------
# Materialized form: derived once per data folder into the shared checkpoint folder, laid
# out like production sources under a SourceCatalog, and scanned through it (typed Parquet,
# partitioned by date).

FIXTURE_VERSION = "v2"
_BUILDERS = {"transactions": transactions, "transfers": transfers, "prices": prices}
_PARTITION = {"transactions": "block_date", "transfers": "block_date", "prices": None}


def _source_names():
    from codetrail.sources import catalog as C

    return {"transactions": C.TRANSACTIONS, "transfers": C.TRANSFERS, "prices": C.PRICES}


def fixture_root(spark: SparkSession, sf_dir: str) -> str:
    """One folder per (Spark application, data folder): concurrent applications never write
    into the same place (a directory rename onto an existing one would nest it)."""
    import hashlib

    from codetrail.session import checkpoint_root

    app = spark.sparkContext.applicationId
    tag = hashlib.sha1(f"{FIXTURE_VERSION}:{sf_dir.rstrip('/')}:{app}".encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/codetrail/fixtures/{tag}"


def fixture_catalog(spark: SparkSession, sf_dir: str):
    from codetrail.sources.catalog import SourceCatalog

    return SourceCatalog(fixture_root(spark, sf_dir))


_MATERIALIZED: dict[tuple[str, str], dict[str, str]] = {}


def materialize(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write the three derived sources once (atomic rename into place); return their paths."""
    import uuid

    from codetrail.session import hadoop_fs

    use_utc(spark)
    memo = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if memo in _MATERIALIZED:
        return _MATERIALIZED[memo]
    cat = fixture_catalog(spark, sf_dir)
    out = {}
    for name, build in _BUILDERS.items():
        final = cat.path(*_source_names()[name])
        fs, p = hadoop_fs(spark, final)
        if not fs.exists(p):
            # Written aside and renamed into place, so a half-written source is never read.
            tmp = f"{cat.root}/_tmp-{name}-{uuid.uuid4().hex[:8]}"
            w = build(spark, sf_dir).write.mode("overwrite")
            if _PARTITION[name]:
                w = w.partitionBy(_PARTITION[name])
            w.parquet(tmp)
            fs.mkdirs(p.getParent())
            if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(tmp), p):
                raise IOError(f"cannot move {tmp} to {final}")
        out[name] = final
    _MATERIALIZED[memo] = out
    return out


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a materialized derived source through the catalog (columns in schema order)."""
    from codetrail.sources.catalog import SOURCE_SCHEMAS

    materialize(spark, sf_dir)
    source = _source_names()[name]
    sch = SOURCE_SCHEMAS[source]
    df = fixture_catalog(spark, sf_dir).read(spark, *source)
    return df.select(*[f.name if f.name not in ("from", "to", "index") else f"`{f.name}`" for f in sch.fields])
