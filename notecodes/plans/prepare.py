"""The Prepare job: scan -> classify -> stage -> dedup -> split -> write -> report.

Lineage is cut once, after classification: the classified rows (rejects
included) are written to the shared checkpoint folder. The regex and leakage
work then runs exactly once, the dedup/split shuffles and the statistics read
the staged table (the statistics read only its narrow columns), and a lost
executor never forces a rescan of the raw source.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from notecodes.config import PrepareOptions
from notecodes.operators.clean import CLEAN_COLUMNS, accepted_rows, classify, cleaning_stats, first_rows, labelled_rows, rejects
from notecodes.operators.profile import dataset_report
from notecodes.session import drop_staged, is_small, scratch_path, spread
from notecodes.sources.io import read_manifest, read_raw, read_split, save_splits, source_listing, table_exists, write_json_document, write_manifest

OUTPUT_COLUMNS = CLEAN_COLUMNS + ("row_no", "split_key", "split")


@dataclass
class Prepared:
    splits: DataFrame      # the written table, read back (partitioned by split)
    stats: DataFrame       # (stat, n)
    rejects: DataFrame     # (row_no, reject_reason)
    stage: str             # the classified rows, which stats, rejects and report read
    make_report: Callable[[], DataFrame]

    @cached_property
    def report(self) -> DataFrame:
        """One row; the texts are read when it is first asked for."""
        return self.make_report()

    def close(self) -> None:
        """Remove the staged rows; only ``splits`` can be read from then on."""
        drop_staged(self.splits.sparkSession, self.stage)


def prepare(spark: SparkSession, raw: DataFrame, out_dir: str, opts: PrepareOptions = PrepareOptions(),
            report_path: str | None = None, stage_dir: str | None = None) -> Prepared:
    """Run the whole Prepare job; returns lazy views over what was written."""
    opts.check()
    stage, ids = stage_dir or scratch_path(spark, "classified"), scratch_path(spark, "kept")
    classify(spread(raw, "row_no", opts.rebalance_input), opts).write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    accepted = accepted_rows(staged)
    first_rows(accepted).write.parquet(ids)  # narrow; the thresholds and the wide semi join both read it
    split_df = labelled_rows(accepted, spark.read.parquet(ids), opts)
    rebalance = not is_small(raw) if opts.rebalance_output is None else opts.rebalance_output
    save_splits(split_df.select(*OUTPUT_COLUMNS), out_dir, opts.output_compression, rebalance)
    drop_staged(spark, ids)
    written = read_split(spark, out_dir)
    stats = cleaning_stats(staged)
    done = Prepared(written, stats, rejects(staged), stage, lambda: dataset_report(raw, written, stats, opts.sample_report_size))
    if report_path:
        write_json_document(done.report, report_path)
    return done


def prepare_source(spark: SparkSession, path: str, out_dir: str, fmt: str = "parquet",
                   opts: PrepareOptions = PrepareOptions(), report_path: str | None = None) -> Prepared:
    """Prepare from a raw source that holds several splits: ``opts.raw_split`` is read."""
    return prepare(spark, read_raw(spark, path, fmt, split=opts.raw_split), out_dir, opts, report_path)


def manifest(raw: DataFrame, opts: PrepareOptions) -> dict:
    """What a prepared table was made from: the options that change its rows, and the source."""
    rows = {k: v for k, v in asdict(opts).items() if k not in ("rebalance_input", "rebalance_output", "output_compression")}
    options = hashlib.sha256(json.dumps(rows, sort_keys=True).encode()).hexdigest()
    return {"format": 1, "options": options, "source": source_listing(raw)}


def load_or_prepare(spark: SparkSession, raw: DataFrame, out_dir: str, opts: PrepareOptions = PrepareOptions(),
                    report_path: str | None = None) -> DataFrame:
    """S3: reuse the written table when it was made from this source with these options, else build it.

    The table's manifest says what it was made from. It is written last and appears by a rename, so a table that a
    broken run left behind, or one of other options or another source, is built anew.
    """
    now = manifest(raw, opts)
    if table_exists(spark, out_dir) and read_manifest(spark, out_dir) == now:
        return read_split(spark, out_dir)
    done = prepare(spark, raw, out_dir, opts, report_path)
    write_manifest(spark, out_dir, now)
    done.close()
    return done.splits


def load_or_prepare_source(spark: SparkSession, path: str, out_dir: str, fmt: str = "parquet", opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """S1 + S3 in one call, from a raw source's path; a table built here has its report beside it (``<out_dir>_report.json``)."""
    raw = read_raw(spark, path, fmt, split=opts.raw_split)
    return load_or_prepare(spark, raw, out_dir, opts, out_dir.rstrip("/") + "_report.json")
