"""Batch inference over JSON-lines notes or a folder of note files (S5/S6 -> F10 -> P5 -> U2 -> P14 -> S11).

The output path is checked before any work (the reference checks it after
predicting). Rows without a note, and lines that are no JSON, are quarantined with
their violations instead of failing the whole job.

The scored rows are written once in the shared folder and put in order from there: a
global sort samples its input before it runs, and above the predictor that would run the model twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.config import PredictOptions
from notecodes.operators.score import PredictorFactory, rule_predictor, score_notes
from notecodes.session import drop_staged, scratch_path
from notecodes.sources.io import read_note_files, read_notes_jsonl, with_row_no, write_jsonl

SCORED_COLUMNS = ("note", "prompt_text", "raw_prediction", "normalized_prediction", "codes")
_SCORED = "prompt_text string, raw_prediction string, normalized_prediction string, codes array<string>"


def write_in_order(scored: DataFrame, key: str, columns: tuple[str, ...], output_path: str) -> None:
    """JSON lines in the order of ``key``; ``scored`` (a model's answers) is computed once."""
    spark, stage = scored.sparkSession, scratch_path(scored.sparkSession, "scored")
    scored.select(key, *(c for c in columns if c != key)).write.parquet(stage)
    write_jsonl(spark.read.parquet(stage).orderBy(key).select(*columns), output_path)
    drop_staged(spark, stage)


def scored_columns(options: PredictOptions) -> tuple[str, ...]:
    return SCORED_COLUMNS + (("was_cut",) if options.max_seq_length else ())


def run_batch_inference(spark: SparkSession, input_path: str, output_path: str | None,
                        factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions(),
                        quarantine_path: str | None = None) -> DataFrame:
    """Score every note of ``input_path`` and write ``note`` + prediction fields, in input order.

    With ``quarantine_path``, rows without a note and broken lines go there with their
    violations. Without it, a broken line is an error and rows without a note are left out.
    """
    if not output_path:
        raise ValueError("An output path is required when an input file is given.")
    notes = with_row_no(read_notes_jsonl(spark, input_path, keep_broken=quarantine_path is not None))
    has_note = F.col("note").isNotNull()  # required; "" is a valid note
    if quarantine_path:
        broken = F.col("broken_line").isNotNull()
        violations = F.when(broken, F.array(F.lit("json"))).otherwise(F.array(F.lit("note")))
        write_jsonl(notes.where(broken | ~has_note).withColumn("violations", violations), quarantine_path)
        has_note = has_note & ~broken
    write_in_order(score_notes(notes.where(has_note).select("row_no", "note", "instruction"), factory, options), "row_no", scored_columns(options), output_path)
    return spark.read.schema(f"note string, {_SCORED}" + (", was_cut boolean" if options.max_seq_length else "")).json(output_path)


def run_folder_inference(spark: SparkSession, input_dir: str, output_path: str | None,
                         factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions(),
                         instruction: str | None = None) -> DataFrame:
    """Score a folder of note files, one note a file, and write ``path`` + ``note`` + prediction fields, by path."""
    if not output_path:
        raise ValueError("An output path is required when a folder of notes is given.")
    notes = read_note_files(spark, input_dir).select("path", "note", F.lit(instruction).cast("string").alias("instruction"))
    write_in_order(score_notes(notes, factory, options, key="path"), "path", ("path", *scored_columns(options)), output_path)
    return spark.read.schema(f"path string, note string, {_SCORED}" + (", was_cut boolean" if options.max_seq_length else "")).json(output_path)
