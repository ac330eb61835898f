"""Clustered compaction: content kept, files small in every clustered column, settled, and only changed partitions due again."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from codetrail.operators import clustering as CL
from codetrail.operators import upsert as U

BY = ["t", "k"]


def rows(spark, n=40_000):
    i = F.col("id")
    return spark.range(n).select(
        F.unhex(F.md5(i.cast("string"))).alias("k"), F.timestamp_seconds(i * 4 % 86_400 + 1_704_067_200).alias("t"), i.alias("v"),
        F.when(i % 1000 == 0, F.lit(None)).otherwise(F.concat(F.lit("x"), i % 7)).alias("s"), (i % 2).cast("int").alias("part"))


def share_read(path, column):
    """Of the files' row groups: the share whose range holds a value, averaged over every 100th value."""
    stats, points = [], []
    for f in glob.glob(f"{path}/part=0/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        points += pq.ParquetFile(f).read(columns=[column])[column].to_pylist()[::100]
        for g in range(meta.num_row_groups):
            c = next(meta.row_group(g).column(x) for x in range(meta.num_columns) if meta.row_group(g).column(x).path_in_schema == column)
            stats.append((c.statistics.min, c.statistics.max))
    return sum(a <= p <= b for p in points for a, b in stats) / len(points) / len(stats), len(stats)


def test_files_are_narrow_in_both_columns_and_a_second_call_finds_nothing(spark, scratch):
    path = scratch + "/t"
    U.write_table(rows(spark).repartition(6), path, "part", rebalance=False)
    before = sorted(spark.read.parquet(path).select("v", "part").collect())
    assert share_read(path, "k")[0] > 0.9
    assert CL.cluster(spark, path, "part", BY, target_file_bytes=20_000) == ["part=0", "part=1"]
    for column in BY:  # a filter on either column skips more than 60 percent of the files
        share, files = share_read(path, column)
        assert files >= 20 and share < 0.4, (column, share, files)
    assert sorted(spark.read.parquet(path).select("v", "part").collect()) == before
    assert CL.cluster(spark, path, "part", BY, target_file_bytes=20_000) == []
    U.replace_partitions(spark, rows(spark).where("part = 1 and v < 100"), path, "part", [1])
    assert CL.cluster(spark, path, "part", BY, target_file_bytes=20_000, round_partitions=1) == ["part=1"]
    assert spark.read.parquet(path).where("part = 1").count() == 50
    assert CL.cluster(spark, path, "part", ["s", "v", "t"], round_partitions=1) == ["part=0", "part=1"]  # another curve
    assert spark.read.parquet(path).count() == 20_050


def test_empty_null_and_wrong_inputs(spark, scratch):
    path = scratch + "/t"
    assert CL.cluster(spark, path, "part", BY) == []
    some = rows(spark, 50).withColumn("t", F.lit(None).cast("timestamp")).withColumn("part", F.when(F.col("v") > 9, F.col("part")))
    U.write_table(some, path, "part")
    assert len(CL.cluster(spark, path, "part", BY)) == 3  # nulls of the partition column are a partition too
    assert spark.read.parquet(path).count() == 50
    for by in (["t"], ["t", "part"], ["t", "k", "v", "s", "t"]):
        with pytest.raises(ValueError):
            CL.cluster(spark, path, "part", by)


def test_code_interleaves_bits(spark):
    got = spark.range(64).select(CL.z_code([(F.col("id") / 8).cast("int"), (F.col("id") % 8).cast("int")], 3).alias("z")).collect()
    want = [sum(((a >> b & 1) << (2 * b + 1)) | ((c >> b & 1) << (2 * b)) for b in range(3)) for a in range(8) for c in range(8)]
    assert [r.z for r in got] == want
