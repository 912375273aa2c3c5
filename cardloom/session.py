"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Cluster-independent settings. Executor sizes, shuffle.partitions and the
# master stay with spark-submit; AQE coalesces an over-large partition count.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the older default keeps no minimum and maximum in file footers, so no filter on a time could skip anything
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # masks the AES key should a caller ever pass it as a literal
    "spark.sql.redaction.string.regex": "(?i)aes_(en|de)crypt\\([^)]*\\)",
}


def build_session(app: str = "cardloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Shuffle partitions for a job over ``input_bytes``: adaptive execution merges
    partitions that turn out small but never adds any, so start high enough."""
    return max(200, -(-input_bytes // partition_bytes))


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Parquet bytes of the tables for one shuffle partition; the widest rows (documents) take about eight times that
INPUT_PER_PARTITION = 8 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Shuffled bytes up to which partitions are merged: narrow rows take over twenty times that in a task's sorts and hash tables
MERGED_BYTES = 16 * 1024 * 1024
READ = "spark.sql.files.maxPartitionBytes"
# Parquet bytes that one task reads: its groups, when it counts before the shuffle, can be as many as its rows
READ_BYTES = 32 * 1024 * 1024


def size_shuffles(spark: SparkSession, folder: str) -> int:
    """Lets adaptive execution start from so many partitions that a task gets the same share of any input and needs not spill.
    Tasks that read get a bounded share, too.

    It merges partitions but never adds any, so a number that fits a small input spills on a large one. What the
    session asks for counts where it is finer. Streams keep the session's own number, as their state is cut by it.
    """
    for key, most in ((ADVISORY, MERGED_BYTES), (READ, READ_BYTES)):
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
            spark.conf.set(key, most)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_PER_PARTITION))
    spark.conf.set(INITIAL_PARTITIONS, parts)
    return parts


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session may leave it unset: then one temporary folder is made for
    the session. On a cluster a machine-local folder would be lost with its
    machine, so the setting is required there.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or _checkpoint_dir(spark)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardloom-"))
        folder = _checkpoint_dir(spark)
    return folder.rstrip("/")


def _checkpoint_dir(spark: SparkSession) -> str | None:
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return found.get() if found.isDefined() else None


_own_folders: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path for one run, below the session's own part of the shared folder.
    That part is deleted when the driver ends."""
    own = f"{shared_dir(spark)}/cardloom/{spark.sparkContext.applicationId}"
    if own not in _own_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own_folders.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def shipped(spark: SparkSession) -> None:
    """Sends the package to the executors, once a session, unless their Python finds it by PYTHONPATH."""
    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped_to:
        return
    _shipped_to.add(context.applicationId)
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


_shipped_to: set[str] = set()
