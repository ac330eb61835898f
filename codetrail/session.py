"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The models' days are UTC days.
TIME_ZONE = "spark.sql.session.timeZone"
UTC_NAMES = {"UTC", "Etc/UTC", "Z", "Zulu", "Etc/Zulu", "UCT", "Etc/UCT", "Universal", "Etc/Universal", "GMT", "Etc/GMT", "+00:00"}

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to the advisory size, not to the default parallelism.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Skip PySpark's per-call capture of Python call sites for error messages: four py4j round
    # trips per Column function, i.e. most of the driver-side plan construction time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "codetrail",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster the launcher owns the session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = {**RECOMMENDED_CONF, TIME_ZONE: "UTC", "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class WrongTimeZone(RuntimeError):
    """The session's time zone is not UTC, so its days are not the models' days."""


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Check what the operators need of the session (UTC day boundaries); the session is left as it is."""
    zone = spark.conf.get(TIME_ZONE)
    if zone not in UTC_NAMES:
        raise WrongTimeZone(f"{TIME_ZONE} is {zone!r}; set it to UTC")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """For applications: put the session into UTC."""
    if spark.conf.get(TIME_ZONE) not in UTC_NAMES:
        spark.conf.set(TIME_ZONE, "UTC")
    return spark


ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def join_as_dealt(spark: SparkSession):
    """Inside, a join takes two sides that are dealt alike by some of its keys as they are, without a shuffle by all
    of them (same rows either way); the setting comes back afterwards."""
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)


_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext checkpoint dir).
    Only when neither is set and the master is ``local`` -- tests -- a private folder is created
    and registered; on a cluster that folder would be another one on every machine, so it is
    refused. The answer is fixed per SparkContext, so every caller sees the same folder.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _ROOTS:
        return _ROOTS[key]
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = sc.getCheckpointDir()
        except Exception:  # pragma: no cover - older API
            root = None
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
        # spark.checkpoint.dir is a core setting and cannot be changed at run time; the
        # SparkContext checkpoint dir can.
        root = tempfile.mkdtemp(prefix="codetrail-ckpt-")
        sc.setCheckpointDir(root)
    _ROOTS[key] = root.rstrip("/")
    return _ROOTS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/codetrail/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def input_bytes(spark: SparkSession, path: str, column: str | None = None, since=None) -> int:
    """Bytes of a table's files (file-system metadata only); with ``since``, of its partitions
    ``column=value`` from that value on."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return 0
    if since is not None:
        days = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith(f"{column}=")]
        if days:
            return sum(int(fs.getContentSummary(x).getLength()) for x in days if x.getName() >= f"{column}={since}")
    return int(fs.getContentSummary(p).getLength())


def shuffle_partitions_for(spark: SparkSession, sizes, bytes_per_partition: int = 256 * 1024 * 1024) -> int:
    """Shuffle partitions so that each holds about ``bytes_per_partition`` of what a run reads.

    ``sizes``: bytes of the sources inside the run's window, so an hourly run does not get the
    partitions of the whole history. There is no upper limit; AQE coalesces what is too small.
    """
    floor = 2 * spark.sparkContext.defaultParallelism
    return int(max(floor, -(-sum(sizes) // bytes_per_partition)))
