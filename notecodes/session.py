"""Session and scratch-folder helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "notecodes") -> SparkSession:
    """A session with the settings these jobs assume (AQE on, UI off, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # partitionBy(split) writes with one open writer per split value instead
        # of sorting every task's rows by the partition column first
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NOTECODES_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set and the master is local (tests, benches) is a private
    temporary folder created and set; on a cluster that would be a folder other
    executors cannot see, so it is an error instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3).")
    local = tempfile.mkdtemp(prefix="notecodes-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)  # staged tables of local runs go with the process
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read back: a lineage cut that survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged table when its job is over."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Input bytes a task slot up to which rows are dealt out anew before heavy work on them.
SMALL_BYTES = 32 << 20


def is_small(df: DataFrame) -> bool:
    """Whether the whole input is small: a few row groups, each of which would be one task."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size < df.sparkSession.sparkContext.defaultParallelism * SMALL_BYTES


def spread(df: DataFrame, key: str, wanted: bool | None = None) -> DataFrame:
    """Hash-partition the rows of a small input by ``key`` over all task slots.

    Hash partitioning (not round-robin) keeps retries deterministic and needs no
    sort. A larger input has splits enough and is never shuffled for this.
    """
    wanted = is_small(df) if wanted is None else wanted
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key) if wanted else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that functions
    that run there can import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_notecodes_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="notecodes-code-")), "notecodes.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(target)  # the driver serves it; no shared path is needed
    context._notecodes_shipped = True


#: Bytes of an Arrow batch, about (one row at least).
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of the Arrow batches that go to Python (both sides of the pipe hold a batch,
    and the default counts rows: long rows would make a batch many times larger)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    said = spark.conf.get(key, None)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said) if said else 0
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized for a run over ``input_bytes`` of raw notes on ``total_cores``.

    The classify stage is CPU-bound (regex over text), so input splits are kept
    at 128 MB; shuffle partitions target ~200 MB each (at least three waves of
    tasks), and AQE coalesces small ones and splits skewed joins at run time.
    Example: 100 TB on 8,000 cores -> 524,288 shuffle partitions.
    """
    mb = 1024 * 1024
    shuffle = max(3 * total_cores, input_bytes // (200 * mb))
    shuffle = 1 << max(0, int(shuffle - 1).bit_length())  # next power of two
    return {
        "spark.sql.files.maxPartitionBytes": str(128 * mb),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    }
