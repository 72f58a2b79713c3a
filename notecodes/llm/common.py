"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.session import bound_batches, scratch_path, ship_package

#: Bits of the membership bitmaps sent to tasks: 2 MB whatever the input's size.
BITMAP_BITS = 24
#: Narrow rows of a staged table for which another file is worth while, when their number is known.
FILE_ROWS = 100_000


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once in the shared folder and read back: later steps do not recompute it, and a lost executor loses nothing.

    With ``rows`` (an upper bound of its rows), as many files as task slots or as ``FILE_ROWS`` asks for are written at most: each
    file costs a local file system a process, and the next step a task.
    """
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // FILE_ROWS + 1))
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_rest(column: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (the held-out folds are defined by it)."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % mod


def held_out(column: str, mod: int, rest: int) -> Column:
    """True where the id's remainder is the held-out one; a null id is never held out."""
    return F.coalesce(crc_rest(column, mod) == rest, F.lit(False))


def bitmap_of(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap (2**BITMAP_BITS bits) of the column's 64-bit values by their top bits.

    Spark aggregates it to at most 2**(BITMAP_BITS - 6) rows, so what reaches
    the driver is bounded; a value whose bit is unset is certainly absent.
    """
    slot = F.shiftrightunsigned(F.col(column), 64 - BITMAP_BITS)
    rows = (
        hashes.select(F.shiftright(slot, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int")).alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits"))
    )
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    got = rows.toArrow()
    if got.num_rows:
        out[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return ((bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def setup(spark: SparkSession) -> None:
    """Make the package importable on the executors, and bound the bytes of Arrow batches."""
    ship_package(spark)
    bound_batches(spark)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, mod: int, rest: int, bound: int) -> DataFrame:
    """(doc_id, text, label) of about ``bound`` training rows at most.

    Rows of the held-out remainder, null ids, null labels and unlabelled documents are never
    in it; rows are taken by a hash of the id, so the sample is the same on every
    run. Only the sampled ids (about ``bound``) are broadcast; texts are not
    shuffled. An id labelled more than once counts by its largest label.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(column).cast("int").alias("label"))
        .where(F.col("label_id").isNotNull() & F.col("label").isNotNull() & ~held_out("label_id", mod, rest))
        .groupBy("label_id").agg(F.max("label").alias("label"))
    )
    total = known.count()
    if total > bound:
        known = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int((1 << 20) * bound / total))
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")


def scored(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of every row; ``model.scores(data, offsets)`` scores a slice of texts."""
    setup(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.scores(*tn.buffer_of(part.column("text"))), pa.float64())], ["doc_id", "score"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def kept_rows(docs: DataFrame, model, keeps) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score passes ``keeps(scores)``."""
    setup(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, at):
                yield part.filter(pa.array(keeps(model.scores(*tn.buffer_of(part.column(at))))))

    return docs.mapInArrow(run, docs.schema)
