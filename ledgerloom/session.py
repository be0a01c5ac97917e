"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Dimensions are never hinted as broadcast: the planner compares their size with
# the threshold, and beyond it joins by shuffle with skewed partitions split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}

# Of written tables, in any session. The first level takes less time than the usual third one, and
# tables of numbers and flags are no larger for it.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

# Bytes of input per shuffle partition and per input split on large data.
_SHUFFLE_BYTES = 512 * 1024 * 1024
_SPLIT_BYTES = 256 * 1024 * 1024


def settings_for(input_bytes: int) -> dict[str, str]:
    """Partition counts for a given amount of raw input.

    The optimizer joins small shuffle partitions but cannot add any, so the number
    must be high enough for a partition to fit the memory of a task.
    """
    partitions = max(200, -(-input_bytes // _SHUFFLE_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_SPLIT_BYTES),
    }


# Bytes of packed columns per shuffle partition: by estimate some 200 MB of rows when unpacked.
_PACKED_BYTES = 8 * 1024 * 1024
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffles_for(spark: SparkSession, packed_bytes: int) -> int:
    """Let shuffles begin with as many partitions as an input of packed columns needs to be sorted
    and grouped in the memory of a task, however few the session asks for. The optimizer joins
    those that turn out small, so a number that is there already is never lowered. Returns the
    number they begin with."""
    given = int(spark.conf.get(_INITIAL, spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = -(-packed_bytes // _PACKED_BYTES)
    if wanted > given:
        spark.conf.set(_INITIAL, str(wanted))
    return max(given, wanted)


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files under a folder, in whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def folder_version(spark: SparkSession, folder: str) -> str:
    """A text that changes when the files under a folder do: how many there are, their bytes, and
    when the folder was last written whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.getContentSummary(path)
    ended = files.getFileStatus(path).getModificationTime()
    return f"{found.getFileCount()}-{found.getLength()}-{ended}"


def build_session(name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session that names none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_folders[context.applicationId]


# Spark takes away the shuffle files of a query when it ends, not when the driver's collector finds them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when it ends, for steps that write tables and go
    on from these: nothing reads the shuffles again. Around all threads that write, not in them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_table(df: DataFrame, path: str) -> None:
    """Written packed as the session settings here ask for, in any session."""
    df.write.mode("overwrite").options(**PACKED).parquet(path)


def materialised(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the files, so lost executors cost no rework."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
