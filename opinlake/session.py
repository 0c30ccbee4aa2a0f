"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from opinlake.layout import LakeLayout

LAKE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Settings for a large cluster. Reduce-side sizes are left to adaptive execution: it
# starts from many partitions and merges them to the advisory size.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state grows with the number of products: keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Files of a shuffle go when what was made of it is written; else they stay until the driver happens to
# collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(
    app_name: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the cluster settings; `settings` and whatever was submitted with the job
    override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAKE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    # Submitted settings are known only now; all of these can be set on a running session.
    given = session.sparkContext.getConf()
    for key, value in CLUSTER_SETTINGS.items():
        if not given.contains(key):
            session.conf.set(key, value)
    return session


def lake_session(app_name: str) -> tuple[SparkSession, LakeLayout]:
    """The session and layout of a job, both set up from the environment."""
    layout = LakeLayout.from_env()
    fs = {"spark.hadoop.fs.defaultFS": layout.default_fs} if layout.default_fs else {}
    return build_session(app_name, settings=fs), layout


def apply_lake_settings(spark: SparkSession) -> None:
    """What the data depends on, for a session built elsewhere: instants in UTC, and stored in
    a form that has minimum and maximum, without which a filter on time skips nothing."""
    for key, value in LAKE_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session while something is run."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    Only a local master (tests) may go without it and gets a temporary folder; on a
    cluster a machine-local folder would be invisible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="opinlake-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/opinlake/{uuid.uuid4().hex}/{name}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path in its terms."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it; one that is not there is fine."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none if it is not there."""
    fs, target = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, in one step."""
    fs, target = file_system(spark, path)
    fs.create(target, True).close()


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a share when a scan has fewer tasks than there are cores.

    Files that cannot be split would otherwise keep the work behind the scan on as many
    tasks. A large input has more scan tasks than cores and passes without a shuffle. Meant
    for plain scans: counting the tasks of a frame with shuffles would run them.
    """
    spark = scan.sparkSession
    if scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return scan
    # A number of cores, not of shuffle partitions: what is written after it keeps few files.
    return scan.repartition(spark.sparkContext.defaultParallelism)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write `df` as a Parquet table in the shared folder and read it back.

    Unlike a cached frame the table outlives lost executors, and later reads prune
    columns and push filters into it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
