"""Sources and sinks (S1-S11): readers with declared schemas, Parquet/JSON writers."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from contextlib import contextmanager
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

RAW_SCHEMA = StructType([
    StructField("ehr_text", StringType(), True),
    StructField("instruction", StringType(), True),
    StructField("output", StringType(), True),
    StructField("icd_code", StringType(), True),
])

NOTES_SCHEMA = StructType([
    StructField("note", StringType(), True),
    StructField("instruction", StringType(), True),
])


#: Rows that a task numbers: monotonically_increasing_id() counts them in its lower bits.
_ROW_BITS = 33
#: The list of files and the rows' metadata write a path without a host differently (file:///a, file:/a).
_EMPTY_HOST = r"^([a-z0-9+.-]+):///"


def _byte_conf(spark: SparkSession, key: str, default: str) -> int:
    said = spark.conf.get(key, default)
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said))  # "128m" as well as bytes


def with_row_no(df: DataFrame) -> DataFrame:
    """Source order as ``row_no`` for file sources without one: unique and ascending by
    file path and place in the file, with gaps. No row is counted and the source is not scanned for it.

    The key is put together from a file's place in the list of paths (upper bits) and the row's place in
    the file: Parquet exposes ``_metadata.row_index``; for text formats (JSON, CSV) it is the number of
    the block, ``_metadata.file_block_start`` over the least size that a block can have, and
    behind it the lower bits of ``monotonically_increasing_id()`` (a task reads a block's rows in turn).
    The list of paths is the one that the driver holds to plan the scan; it is broadcast, and no wide
    row is shuffled. A place that does not fit into its bits is an error.
    """
    if "row_no" in df.columns:
        return df
    spark = df.sparkSession
    paths = sorted(re.sub(_EMPTY_HOST, r"\1:/", p) for p in df.inputFiles())
    room = 63 - max(0, len(paths) - 1).bit_length()
    if "row_index" in df.select("_metadata").schema["_metadata"].dataType.fieldNames():
        place = F.col("_metadata.row_index")
    else:
        block = min(_byte_conf(spark, "spark.sql.files.maxPartitionBytes", "128m"), _byte_conf(spark, "spark.sql.files.openCostInBytes", "4m"))
        number = F.floor(F.col("_metadata.file_block_start") / F.lit(max(block, 1)))
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        place = F.when(number < F.lit(1 << max(0, room - _ROW_BITS)), F.shiftleft(number, _ROW_BITS).bitwiseOR(row))
    placed = df.select("*", F.regexp_replace("_metadata.file_path", _EMPTY_HOST, "$1:/").alias("_file"), place.alias("_place"))
    files = spark.createDataFrame(list(zip(paths, range(len(paths)))) or [("", 0)], "_file string, _file_no long")
    fits = F.col("_place").isNotNull() & F.col("_file_no").isNotNull()
    key = F.shiftleft(F.col("_file_no"), room).bitwiseOR(F.col("_place")) if room < 63 else F.col("_place")
    return (
        placed.join(F.broadcast(files), "_file", "left")
        .withColumn("row_no", F.when(fits, key).otherwise(F.raise_error(F.concat(F.lit("No room for a row number in "), F.col("_file")))))
        .drop("_file", "_place", "_file_no")
    )


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None,
             split_col: str = "split") -> DataFrame:
    """Scan the raw examples; pick one split by name when the source holds several.

    A split that the source does not have, or a source without the split column,
    is an error. So is a broken JSON line (it would otherwise be a row of nulls).
    """
    reader = spark.read
    if fmt in ("json", "csv"):
        schema = RAW_SCHEMA
        if split is not None:
            schema = StructType(RAW_SCHEMA.fields + [StructField(split_col, StringType(), True)])
        reader = reader.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "FAILFAST")
        if fmt == "csv":
            reader = reader.option("header", "true").option("multiLine", "true").option("escape", '"')
    # Numbered before the split filter: the order is that of the whole source.
    df = with_row_no(reader.format(fmt).load(path))
    if split is None:
        return df
    if split_col not in df.columns:
        raise ValueError(f"{path} has no column {split_col!r} to pick {split!r} by.")
    df = df.where(F.col(split_col) == split)
    if df.isEmpty():
        raise ValueError(f"{path} has no split {split!r}.")
    return df


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str, only_if: str | None = None):
    """Set a SQL conf for the duration of a block, then restore it.

    With ``only_if``, the value is set only when the current one equals it.
    """
    old = spark.conf.get(key, None)
    change = only_if is None or (old or "") == only_if
    if change:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if change:
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


def save_splits(split_df: DataFrame, out_dir: str, compression: str | None = None, rebalance: bool = False) -> None:
    """One table, partitioned by ``split`` (readers prune to one split).

    With at most a few open writers per task (one per split value) the writer
    does not sort the wide rows by ``split`` first; that needs
    ``spark.sql.maxConcurrentOutputFileWriters`` > 0, set here for the write
    when the session leaves it at 0.

    ``rebalance`` deals the rows out by split first and lets AQE cut and merge by measured bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so that the number of files follows
    the bytes of a split and not the number of tasks.
    """
    if rebalance:
        split_df = split_df.hint("rebalance", "split")
    writer = split_df.write.mode("overwrite").partitionBy("split")
    if compression:
        writer = writer.option("compression", compression)
    with session_conf(split_df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "4", only_if="0"):
        writer.parquet(out_dir)


def read_split(spark: SparkSession, out_dir: str, split: str | None = None) -> DataFrame:
    """Read the prepared table; a split filter prunes partitions."""
    df = spark.read.parquet(out_dir)
    return df if split is None else df.where(F.col("split") == split)


def table_exists(spark: SparkSession, path: str) -> bool:
    """``path/_SUCCESS`` exists, through the Hadoop file system of ``path``."""
    fs, hpath = _hadoop(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(hpath))


def _hadoop(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def source_listing(df: DataFrame) -> str:
    """A digest of what ``df`` reads: paths, sizes and times of its files, and its plan."""
    spark, digest = df.sparkSession, hashlib.sha256()
    wanted = {p: None for p in sorted(df.inputFiles())}
    for folder in sorted({p.rsplit("/", 1)[0] for p in wanted}):  # one listing a folder, not one call a file
        fs, hpath = _hadoop(spark, unquote(folder))
        for status in fs.listStatus(hpath):
            name = f"{folder}/{quote(status.getPath().getName())}"
            if not status.isDirectory():
                digest.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    digest.update(re.sub(r"#\d+L?|\[file:[^\]]*\]", "", plan).encode())
    return digest.hexdigest()


def manifest_path(out_dir: str) -> str:
    return out_dir.rstrip("/") + "/_manifest.json"  # names with _ are no data files


def write_manifest(spark: SparkSession, out_dir: str, manifest: dict) -> None:
    """The manifest appears whole or not at all: written beside, then renamed."""
    fs, target = _hadoop(spark, manifest_path(out_dir))
    _, draft = _hadoop(spark, manifest_path(out_dir) + f".{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"{draft} could not be renamed.")


def read_manifest(spark: SparkSession, out_dir: str) -> dict | None:
    fs, target = _hadoop(spark, manifest_path(out_dir))
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_notes_jsonl(spark: SparkSession, path: str, keep_broken: bool = False) -> DataFrame:
    """JSON-lines notes with a declared schema; blank lines are skipped.

    A broken line is an error; with ``keep_broken`` it is a row of its own, with its text in ``broken_line``.
    """
    if not keep_broken:
        return spark.read.schema(NOTES_SCHEMA).option("mode", "FAILFAST").json(path)
    schema = StructType(NOTES_SCHEMA.fields + [StructField("broken_line", StringType(), True)])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "broken_line").json(path)


def read_note_files(spark: SparkSession, path: str) -> DataFrame:
    """A directory of note files, one row per file (``path``, ``note``, plus
    any partition columns found in the folder names)."""
    df = spark.read.text(path, wholetext=True)
    extra = [c for c in df.columns if c != "value"]
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("note"), *extra)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8, non-ASCII kept, nulls written as ``null``."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_document(one_row: DataFrame, path: str) -> None:
    """A one-row DataFrame (a global aggregate) as one JSON document.

    One row, so a single output task is safe.
    """
    doc = one_row.select(F.to_json(F.struct(*one_row.columns), {"ignoreNullFields": "false"}).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("json"))


def metrics_path(path: str) -> str:
    """The metrics document beside a prediction file: its last suffix becomes ``.metrics.json``."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name.lstrip(".") else name
    return f"{folder}{slash}{stem}.metrics.json"


def write_evaluation(pred_rows: DataFrame, metrics_row: DataFrame, path: str, split: str, model_id: str) -> None:
    """Prediction rows as JSON lines, plus their ``.metrics.json`` (``metrics_path``) with
    ``split, metrics, model_id, num_examples``."""
    write_jsonl(pred_rows, path)
    metric_cols = [c for c in metrics_row.columns if c != "num_examples"]
    doc = metrics_row.select(
        F.lit(split).alias("split"),
        F.struct(*metric_cols).alias("metrics"),
        F.lit(model_id).alias("model_id"),
        F.col("num_examples").cast(LongType()).alias("num_examples"),
    )
    write_json_document(doc, metrics_path(path))
