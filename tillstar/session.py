"""Session helpers: SQL settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the jobs rely on; all of them are session-scoped."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even when a later aggregate then needs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # String-heavy shuffles compress well: a megabyte of them is much work for one task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
        # What a query shuffled goes when it ends; else it lies on the disks until the driver's JVM happens to collect its plan.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where that is unset (tests), a folder under the SQL warehouse is used, which
    every executor of a session shares as well; never a machine-local temporary
    folder. The Spark context gets the same folder, for the estimators that
    checkpoint by themselves. What a session wrote is deleted when it ends.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _ROOTS:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        _ROOTS[sc.applicationId] = root.rstrip("/")
        atexit.register(_drop_at_exit, spark)
    return _ROOTS[sc.applicationId]


def _drop_at_exit(spark: SparkSession) -> None:
    """A session that has already ended can no longer reach its storage."""
    with contextlib.suppress(Exception):
        drop_scratch(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tillstar/{app}/{label}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any storage Spark can write to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once their readers are done."""
    fs, path = hadoop_path(spark, f"{scratch_root(spark)}/tillstar/{spark.sparkContext.applicationId}")
    fs.delete(path, True)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives an executor, keeps the columnar
    layout (pruning still works) and gives Catalyst a true size for its
    broadcast decision. ``compression`` is the session's unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


BUCKET_BYTES = 16 << 20  # of input files to a bucket
#: A bucket this many times the mean, and of this size, holds a hot key: a join of shuffled rows, which AQE splits, is better then.
HOT_BUCKET, HOT_BYTES = 4, 64 << 20


def bucket_count(spark: SparkSession, size: int) -> int:
    """Buckets for input files of ``size`` bytes (0: not known): a divisor or a multiple of the shuffle's partitions,
    so that a partition of rows dealt by the same key holds few buckets and hardly more files than tasks are written."""
    parts = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if not size:
        return parts
    wanted = max(-(-size // BUCKET_BYTES), spark.sparkContext.defaultParallelism)
    if wanted >= parts:
        return -(-wanted // parts) * parts
    return next(n for n in range(wanted, parts + 1) if parts % n == 0)


def input_size(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads; 0 where it reads none."""
    total = 0
    for name in df.inputFiles():
        fs, path = hadoop_path(df.sparkSession, name)
        total += fs.getFileStatus(path).getLen()
    return total


def materialize_buckets(df: DataFrame, label: str, key: str, buckets: int, order: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """``materialize`` for a table whose rows are joined or grouped by ``key`` later: they lie in buckets of it, sorted
    by ``order``, and are not shuffled again. Also tells whether they do: a table with a hot key is read without its
    buckets. The catalog knows the table only until it is read; the files are the scratch folder's."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = f"tillstar_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, key)
    (writer.sortBy(*order) if order else writer).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    fs, folder = hadoop_path(spark, path)
    sizes = dict.fromkeys(range(buckets), 0)
    for f in fs.listStatus(folder):
        if found := re.search(r"_(\d{5,})\.", f.getPath().getName()):
            sizes[int(found[1])] += f.getLen()
    hot = max(sizes.values()) > max(HOT_BYTES, HOT_BUCKET * sum(sizes.values()) / buckets)
    return (spark.read.schema(df.schema).parquet(path), False) if hot else (table, True)


STORE_BYTES = 160  # of a store's row in a broadcast: five columns, four of them texts, and its place in the hash table
BROADCAST_BYTES = 64 << 20


def broadcast_stores(stores: DataFrame, number: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``stores`` for a broadcast join where that many of them fit, else as they are."""
    return F.broadcast(stores) if number * STORE_BYTES <= limit else stores


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Submit independent jobs at the same time, so that one job's last tasks do not
    leave the cluster idle. Results in the given order; the first error is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
