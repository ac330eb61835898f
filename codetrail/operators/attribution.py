"""Models 1 and 2: decode the calldata trailer of transactions, attach it to transfers.

Both are narrow (map-only) except the transfer join. Filters are written against the
source columns so they reach the Parquet scan as pushed filters / partition filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetrail import schemas
from codetrail.functions import trailer
from codetrail.functions.windows import Floors, Lookback, apply_window
from codetrail.session import ensure_conf

HELPER_COLUMNS = ["calldata", "calldata_len", "tail_marker", "schema_id", "code_len"]


def select_transactions(tx: DataFrame, floors: Floors = Floors(), window: Lookback | None = None) -> DataFrame:
    """22-column projection, ``data`` -> ``calldata``, byte length, floors and window.

    Rows whose calldata is NULL or at most 18 bytes are dropped (not flagged).
    """
    ensure_conf(tx.sparkSession)
    df = tx.where((trailer.byte_length("data") > trailer.MIN_CALLDATA_BYTES) & floors.tx_pred())
    df = apply_window(df, window)
    return df.select(
        *[F.col(f"`{c}`") for c in schemas.TX_PASSTHROUGH],
        F.col("data").alias("calldata"),
        trailer.byte_length("data").alias("calldata_len"),
    )


def parse_trailer(df: DataFrame, data: str = "calldata", n: str = "calldata_len") -> DataFrame:
    """Marker (16 bytes), schema id (1 byte) and code length (1 byte) from the end."""
    nc = F.col(n)
    return df.withColumns({
        "tail_marker": trailer.tail_marker(data, nc),
        "schema_id": trailer.schema_id(data, nc),
        "code_len": trailer.code_len(data, nc),
    })


def extract_code(df: DataFrame, data: str = "calldata", n: str = "calldata_len") -> DataFrame:
    """``multi_code`` when marker, schema id, length range and room all hold, else NULL."""
    return df.withColumn(
        "multi_code",
        trailer.multi_code(data, F.col(n), F.col("tail_marker"), F.col("schema_id"), F.col("code_len")),
    )


def split_codes(df: DataFrame, mc: str = "multi_code") -> DataFrame:
    """Flag plus the two codes. Only the second one is blank-guarded."""
    return df.withColumns({
        "has_builder_code": F.col(mc).isNotNull(),
        "builder_code": trailer.first_code(mc),
        "builder_code2": trailer.second_code(mc),
    })


def attribute_transactions(tx: DataFrame, floors: Floors = Floors(), window: Lookback | None = None) -> DataFrame:
    """C4 ``transactions_attributed``: one row per transaction with at least 19 calldata bytes."""
    df = split_codes(extract_code(parse_trailer(select_transactions(tx, floors, window))))
    return df.select(*[F.col(f"`{c}`") for c in schemas.TX_ATTRIBUTED_COLUMNS])


def select_transfers(tr: DataFrame, chain: str = "celo", floors: Floors = Floors(),
                     window: Lookback | None = None) -> DataFrame:
    """Transfers of one chain above the floors, inside the window."""
    ensure_conf(tr.sparkSession)
    df = tr.where((F.col("blockchain") == F.lit(chain)) & floors.tx_pred())
    df = apply_window(df, window)
    return df.select(*[F.col(f"`{c}`") for c in schemas.TRANSFER_PASSTHROUGH])


def attribution_keys(ta: DataFrame, floors: Floors = Floors(), window: Lookback | None = None,
                     tagged_only: bool = False) -> DataFrame:
    """The 5-column slice of ``transactions_attributed`` used by the transfer join.

    ``tagged_only=True`` keeps only tagged transactions. The left join maps an untagged match
    and a missing match alike (flag false, NULL codes), so the result is identical whenever
    ``hash`` is unique -- which the quality checks assert -- and the join's right side
    shrinks to the tagged fraction. Off by default: with a duplicated hash the reference fans
    out on untagged duplicates too.
    """
    ensure_conf(ta.sparkSession)
    df = ta.where(floors.date_pred())
    df = apply_window(df, window)
    if tagged_only:
        df = df.where(F.col("has_builder_code"))
    return df.select("hash", *schemas.ATTRIBUTION_COLUMNS)


def attribute_transfers(transfers: DataFrame, keys: DataFrame) -> DataFrame:
    """C7 ``transfers_attributed``: transfers LEFT JOIN attribution ON tx_hash = hash.

    Sort-merge join on a uniformly distributed hash; AQE splits a hot ``tx_hash`` on the
    (preserved) left side and turns the join into a broadcast when the right side is
    measured small at run time.
    """
    t = transfers.alias("t")
    a = keys.alias("a")
    return _attributed(t.join(a, F.col("t.tx_hash") == F.col("a.hash"), "left"))


def _attributed(joined: DataFrame) -> DataFrame:
    return joined.select(
        *[F.col(f"t.`{c}`") for c in schemas.TRANSFER_PASSTHROUGH],
        F.coalesce(F.col("a.has_builder_code"), F.lit(False)).alias("has_builder_code"),
        F.col("a.multi_code"),
        F.col("a.builder_code"),
        F.col("a.builder_code2"),
    )


#: Transfers of one file of a day, as :func:`attribute_by_day` deals them.
TRANSFERS_PER_FILE = 250_000


def rows_by_day(transfers: DataFrame, most: int) -> dict | None:
    """Transfers of each day; None if they lie on more than ``most`` days."""
    days = transfers.groupBy("block_date").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    return {r["block_date"]: r["n"] for r in days} if len(days) <= most else None


def attribute_by_day(transfers: DataFrame, keys: DataFrame, counts: dict) -> DataFrame:
    """C7 for a table written by day: the rows of :func:`attribute_transfers`, already dealt by day.

    Joined by hash, wide transfers move twice: to the join and, gathered by day, to the write. Here they move
    once, by (day, file), and are written as they come out of the join; narrow rows move more often: the days of a
    hash's transfers (a transaction lies on one day; where a hash has more, the days between are tried too)
    send each transaction's attribution to those days. ``counts`` (:func:`rows_by_day`) sizes the files; a day
    that it lacks is one file. Written under :func:`~codetrail.session.join_as_dealt`.
    """
    spark = transfers.sparkSession
    files = {d: -(-n // TRANSFERS_PER_FILE) for d, n in counts.items()}
    tasks = min(sum(files.values()), 2 * -(-sum(counts.values()) // TRANSFERS_PER_FILE))
    # with fewer tasks than the session's shuffles have, the join would deal its sides anew
    number = [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    of_day = F.broadcast(spark.createDataFrame(list(files.items()), "_day date, _files int"))

    def dealt(df: DataFrame, spread: Column) -> DataFrame:
        with_files = df.join(of_day, "_day", "left")
        return with_files.withColumn("_file", F.pmod(spread, F.coalesce("_files", F.lit(1)))).repartition(*number, "_day", "_file")

    spans = (transfers.where(F.col("tx_hash").isNotNull()).groupBy("tx_hash")
             .agg(F.min("block_date").alias("_first"), F.max("block_date").alias("_last")))
    sent = (keys.join(spans, F.col("hash") == F.col("tx_hash"))
            .select(*keys.columns, F.explode(F.sequence("_first", "_last")).alias("_day")))
    # transfers without a hash match nothing and are spread by their own key
    spread = F.when(F.col("tx_hash").isNull(), F.xxhash64("unique_key")).otherwise(F.xxhash64("tx_hash"))
    t = dealt(transfers.withColumn("_day", F.col("block_date")), spread).alias("t")
    a = dealt(sent, F.xxhash64("hash")).alias("a")
    on = (F.col("t._day") == F.col("a._day")) & (F.col("t._file") == F.col("a._file")) & (F.col("t.tx_hash") == F.col("a.hash"))
    return _attributed(t.join(a, on, "left"))
