"""Source-name resolution and typed scans.

A source is addressed as ``(source, table)``. The catalog maps it to a storage
location; a ``database`` override swaps the root for every source at once (the
reference overrides the catalog of all sources the same way). Scans always use an
explicit schema, so no inference job runs and types are checked on read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from codetrail import schemas
from codetrail.session import ensure_conf, hadoop_fs

# Logical source names used by the models.
TRANSACTIONS = ("celo", "transactions")
TRANSFERS = ("tokens", "transfers")
PRICES = ("prices", "day")

SOURCE_SCHEMAS: dict[tuple[str, str], T.StructType] = {
    TRANSACTIONS: schemas.TRANSACTIONS,
    TRANSFERS: schemas.TRANSFERS,
    PRICES: schemas.PRICES,
}


@dataclass
class SourceCatalog:
    """Maps (source, table) to a location: ``{root}/{database}/{source}/{table}`` unless pinned."""

    root: str
    database: str = "main"
    pinned: dict[tuple[str, str], str] = field(default_factory=dict)
    fmt: str = "parquet"

    def path(self, source: str, table: str) -> str:
        key = (source, table)
        if key in self.pinned:
            return self.pinned[key]
        return f"{self.root.rstrip('/')}/{self.database}/{source}/{table}"

    def with_database(self, database: str) -> "SourceCatalog":
        return SourceCatalog(self.root, database, dict(self.pinned), self.fmt)

    def read(self, spark: SparkSession, source: str, table: str, schema: T.StructType | None = None,
             since: dt.date | None = None, column: str = "block_date") -> DataFrame:
        """``since``: only the partitions ``column=date`` from that date on are given to Spark, so an
        hourly run lists the files of its window and not of the whole history (tables partitioned
        in another way are read whole; the caller's own filter applies either way)."""
        ensure_conf(spark)
        sch = schema or SOURCE_SCHEMAS.get((source, table))
        reader = spark.read.format(self.fmt)
        if sch is not None:
            reader = reader.schema(sch)
        path = self.path(source, table)
        recent = partitions_since(spark, path, column, since) if since is not None else None
        return reader.option("basePath", path).load(recent) if recent else reader.load(path)


def partitions_since(spark: SparkSession, path: str, column: str, since: dt.date) -> list[str]:
    """Directories ``column=date`` of a table from a date on (one listing of its top level); none if it has no such directories."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return [f"{path}/{n}" for n in sorted(names) if n.startswith(f"{column}=") and n >= f"{column}={since.isoformat()}"]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan a materialized model (``ref``) or any Parquet location with an optional fixed schema."""
    ensure_conf(spark)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: a named, recomputed-per-query relation."""
    df.createOrReplaceTempView(name)
    return df
