"""Clustered compaction (K9): the rows of each partition laid out along a space-filling curve.

Sorting by one column lets a scan skip files and row groups for that column alone. Here two (or
more) columns are cut into ``2**BITS`` equal steps each, and the bits of the steps are interleaved
(a Z-order code); rows are range-partitioned and sorted by (partition, code). Each file then covers
a small range of every column, so a filter on any of them skips most row groups.

A layout table beside the data (``<path>_layout``) records how each clustered directory was left:
files, bytes and the time of the last change. A directory is due again only when its listing
differs, so a second call finds nothing. Nothing but directory listings of due partitions comes to
the driver, ``round_partitions`` at a time.
"""

from __future__ import annotations

from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetrail.operators import upsert
from codetrail.session import ensure_conf, path_exists

#: Steps of each column: 2**BITS.
BITS = 16
LAYOUT = "directory string, files long, bytes long, changed timestamp, curve string"


def number(column: str, dtype: str) -> Column:
    """A column as a double that rises with it: numbers and times as they are, binary and text by their first six bytes."""
    c = F.col(f"`{column}`")
    if dtype in ("binary", "string"):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if dtype == "date":
        return F.unix_date(c).cast("double")
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def z_code(steps: list[Column], bits: int = BITS) -> Column:
    """Bits of the steps, interleaved from the highest down: one long."""
    code = F.lit(0).cast("long")
    n = len(steps)
    for b in range(bits):
        for i, s in enumerate(steps):
            bit = F.shiftright(s, b).bitwiseAND(F.lit(1))
            code = code.bitwiseOR(F.shiftleft(bit.cast("long"), b * n + (n - 1 - i)))
    return code


def listing(spark: SparkSession, path: str, partition_by: str | list[str], curve: str) -> DataFrame:
    """``directory, files, bytes, changed, curve`` of every partition directory (metadata only)."""
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    pattern = "((?:/[^/]+=[^/]*){%d})/[^/]+$" % len(columns)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length", "modificationTime"))
    return (files.withColumn("directory", F.regexp_extract("path", pattern, 1)).where(F.col("directory").startswith(f"/{columns[0]}="))
            .groupBy("directory").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("changed"))
            .withColumn("curve", F.lit(curve)))


def cluster(spark: SparkSession, path: str, partition_by: str, by: list[str], target_file_bytes: int = 128 * 1024 * 1024,
            round_partitions: int = 10_000) -> list[str]:
    """Rewrite the partitions that are not (or no longer) laid out along the curve of ``by``; returns their directories.

    ``by``: two to four columns other than the partition column. Nulls come first. Files have about
    ``target_file_bytes``. Rows and partitions stay as they are, empty tables included; another
    ``by`` makes every partition due.
    """
    ensure_conf(spark)
    if not 2 <= len(by) <= 4 or partition_by in by:
        raise ValueError(f"cluster by two to four columns other than {partition_by}, not {by}")
    if not path_exists(spark, path):
        return []
    curve, layout, done, last = ",".join(by), f"{path}_layout", [], ""
    while True:
        now = listing(spark, path, partition_by, curve)
        if path_exists(spark, layout):
            now = now.join(spark.read.schema(LAYOUT).parquet(layout), ["directory", "files", "bytes", "changed", "curve"], "left_anti")
        # in order of the directories, each once: what another writer changes meanwhile waits for the next call
        due = now.where(F.col("directory") > last).orderBy("directory").limit(round_partitions).collect()
        if not due:
            return sorted(d.strip("/") for d in done)
        _cluster_some(spark, path, partition_by, by, [r["directory"] for r in due],
                      sum(max(1, -(-r["bytes"] // target_file_bytes)) for r in due))
        done += [r["directory"] for r in due]
        last = done[-1]
        _record(spark, path, partition_by, curve, layout, [r["directory"] for r in due])


@contextmanager
def _times_with_statistics(spark: SparkSession):
    """Times are written as microseconds: Parquet keeps no minimum and maximum of Spark's default (96 bits), so nothing could be skipped."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _cluster_some(spark: SparkSession, path: str, partition_by: str, by: list[str], directories: list[str], files: int) -> None:
    target = spark.read.parquet(path)
    texts = [unquote(d.split("=", 1)[1]) for d in directories]
    part = F.col(f"`{partition_by}`")
    wanted = F.coalesce(part.cast("string"), F.lit(upsert.NULL_DIRECTORY)).isin(texts)
    rows, types = target.where(wanted), dict(target.dtypes)
    places = [number(c, types[c]) for c in by]
    # ranges by partition, so days far apart do not share steps of a time column: one row for each of at most
    # ``round_partitions`` partitions, which bounds the broadcast
    ends = rows.groupBy(part.alias("_part")).agg(*[f(p).alias(f"_{name}{i}") for i, p in enumerate(places) for name, f in (("lo", F.min), ("hi", F.max))])
    spread = rows.join(F.broadcast(ends), part.eqNullSafe(F.col("_part")))
    steps = []
    for i, p in enumerate(places):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        steps.append(F.coalesce(F.least(F.lit((1 << BITS) - 1), F.floor((p - lo) / F.greatest(hi - lo, F.lit(1e-9)) * (1 << BITS))).cast("int"), F.lit(0)))
    coded = spread.withColumn("_code", z_code(steps))
    with _times_with_statistics(spark):
        (coded.repartitionByRange(files, partition_by, "_code").sortWithinPartitions(partition_by, "_code")
         .select(*[F.col(f"`{c}`") for c in target.columns]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))


def _record(spark: SparkSession, path: str, partition_by: str, curve: str, layout: str, directories: list[str]) -> None:
    """Note how the directories were left (a new file in the layout table; older notes of them no longer match their listing)."""
    spark.catalog.refreshByPath(path)
    noted = listing(spark, path, partition_by, curve).where(F.col("directory").isin(directories))
    noted.coalesce(1).write.mode("append").parquet(layout)   # one row for each of at most ``round_partitions`` directories
