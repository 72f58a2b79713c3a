"""The Evaluate job: S2 -> L1 -> U2 -> J1 -> M1 -> A9 -> S10.

Given predictions (the normal case) are read once: one full outer join with the prepared table gives the
pairs and whatever does not pair. Without them, ``batch_predict`` runs the predictor on the prompts.
Either way the rows with their metrics are written once in the shared folder. The check of the
pairing, the metrics and the prediction file read them from there, so a predictor (a model) runs once,
and the written predictions and the metrics agree even for a sampling predictor.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.config import EvaluateOptions, GenerationOptions, PredictOptions
from notecodes.operators import evaluate
from notecodes.operators.score import PredictorFactory, batch_predict, rule_predictor
from notecodes.operators.split import last_in_limit
from notecodes.session import drop_staged, scratch_path
from notecodes.sources.io import metrics_path, read_split, write_evaluation


def asked_rows(table: DataFrame, opts: EvaluateOptions) -> Column:
    """Which rows of the prepared table are evaluated: the split's, up to ``max_samples`` in split order."""
    asked = F.col("split") == opts.split
    if opts.max_samples is None:
        return asked
    if opts.max_samples == 0:
        return F.lit(False)
    last = last_in_limit(table.where(asked), opts.max_samples)
    return asked & F.coalesce(F.col("split_key") <= last, F.lit(True))


def evaluation_rows(spark: SparkSession, prepared_dir: str, opts: EvaluateOptions = EvaluateOptions(),
                    predictions: DataFrame | None = None, factory: PredictorFactory = rule_predictor, stage: str | None = None) -> DataFrame:
    """Per-row metrics for the chosen split (limited to ``max_samples`` in split order), written to ``stage``."""
    stage = stage or scratch_path(spark, "evaluated")
    table = read_split(spark, prepared_dir)
    if predictions is None:
        refs = read_split(spark, prepared_dir, opts.split).where(asked_rows(table, opts))
        popts = PredictOptions(**{f.name: getattr(opts, f.name) for f in fields(GenerationOptions)})
        pairs = batch_predict(refs.select("example_id", "prompt_text", "target_text"), factory, popts)
        evaluate.example_metric_rows(pairs).write.mode("overwrite").parquet(stage)
        return spark.read.parquet(stage)
    met = evaluate.paired_once(table, predictions, asked_rows(table, opts))
    evaluate.example_metric_rows(met).write.mode("overwrite").parquet(stage)
    rows = spark.read.parquet(stage)
    evaluate.require_paired(rows)
    return rows.drop("_asked", "_predictions")


def run_evaluation(spark: SparkSession, prepared_dir: str, output_path: str, opts: EvaluateOptions = EvaluateOptions(),
                   predictions: DataFrame | None = None, factory: PredictorFactory = rule_predictor) -> DataFrame:
    """Write the prediction rows and its ``.metrics.json``; return the metrics row."""
    stage = scratch_path(spark, "evaluated")
    per_row = evaluation_rows(spark, prepared_dir, opts, predictions, factory, stage)
    found = evaluate.evaluation_aggregates(per_row)
    metrics = spark.createDataFrame([found.first()], found.schema)  # one row: the staged table can go
    write_evaluation(evaluate.prediction_records(per_row), metrics, output_path, opts.split, opts.model_id)
    drop_staged(spark, stage)
    return metrics


def read_metrics(spark: SparkSession, output_path: str) -> DataFrame:
    """The ``.metrics.json`` document as one row of typed columns."""
    doc = spark.read.json(metrics_path(output_path))
    return doc.select("split", "model_id", "num_examples", "metrics.*")


