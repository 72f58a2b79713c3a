"""Continuous scoring of arriving notes with Structured Streaming.

Each micro-batch fills request defaults, checks the request ranges (F10),
builds prompts for the valid rows, runs the predictor through ``mapInArrow``
and parses its answers (P14). Valid rows go to the sink, invalid ones (with
their violations) to a quarantine folder. Both writes go to a folder named by
the batch id with mode ``overwrite``, so a batch replayed after a failure
replaces its own output: the sink stays exactly-once. Stateless; no port.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from notecodes.config import PredictOptions
from notecodes.operators.checks import request_violations
from notecodes.operators.score import SETTINGS, PredictorFactory, rule_predictor, score_notes

MAX_FILES = 256

STREAM_NOTES_SCHEMA = StructType([
    StructField("row_no", LongType(), True),
    StructField("note", StringType(), True),
    StructField("instruction", StringType(), True),
    StructField("max_new_tokens", IntegerType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("top_p", DoubleType(), True),
    StructField("do_sample", BooleanType(), True),
    StructField("num_beams", IntegerType(), True),
    StructField("broken_line", StringType(), True),
])


def with_request_defaults(notes: DataFrame, options: PredictOptions = PredictOptions()) -> DataFrame:
    """Missing request settings take the job's defaults."""
    return notes.withColumns({
        "max_new_tokens": F.coalesce("max_new_tokens", F.lit(options.max_new_tokens)),
        "temperature": F.coalesce("temperature", F.lit(options.temperature)),
        "top_p": F.coalesce("top_p", F.lit(options.top_p)),
        "do_sample": F.coalesce("do_sample", F.lit(options.do_sample)),
        "num_beams": F.coalesce("num_beams", F.lit(options.num_beams)),
    })


def with_broken_lines(checked: DataFrame) -> DataFrame:
    """A line that is no JSON is one violation of its own; its text stays in ``broken_line``."""
    broken = F.col("broken_line").isNotNull()
    return checked.withColumns({
        "violations": F.when(broken, F.array(F.lit("json"))).otherwise(F.col("violations")),
        "valid": F.col("valid") & ~broken,
    })


def score_micro_batch(batch: DataFrame, batch_id: int, sink_dir: str, quarantine_dir: str,
                      factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions()) -> None:
    checked = with_broken_lines(request_violations(with_request_defaults(batch, options))).persist()
    try:
        valid = checked.where(F.col("valid")).select("row_no", "note", "instruction", *SETTINGS)
        scored = score_notes(valid, factory, options)
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")
        bad = checked.where(~F.col("valid")).drop("valid")
        bad.write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}")
    finally:
        checked.unpersist()


def start_scoring(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  quarantine_dir: str | None = None, factory: PredictorFactory = rule_predictor,
                  options: PredictOptions = PredictOptions(), available_now: bool = True,
                  max_files_per_trigger: int | None = MAX_FILES) -> StreamingQuery:
    """Start the scoring stream over JSON-lines note files arriving in ``source_dir``.

    A micro-batch takes ``max_files_per_trigger`` files at most, so a backlog is
    worked off in bounded batches.
    """
    reader = spark.readStream.schema(STREAM_NOTES_SCHEMA).option("columnNameOfCorruptRecord", "broken_line")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    notes = reader.json(source_dir)
    quarantine = quarantine_dir or f"{sink_dir.rstrip('/')}_quarantine"

    def write(batch: DataFrame, batch_id: int) -> None:
        score_micro_batch(batch, batch_id, sink_dir, quarantine, factory, options)

    writer = notes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_stream_once(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                    factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions(),
                    quarantine_dir: str | None = None) -> DataFrame:
    """Process everything available now, then read the scored rows back."""
    q = start_scoring(spark, source_dir, sink_dir, checkpoint_dir, quarantine_dir, factory, options, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink_dir)
