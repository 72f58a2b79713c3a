"""Shape for training: load or prepare, limit, prompt/completion, checks, write.

Ends with a written training table (Parquet or JSON lines) that any trainer can
read; the trainer itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.config import PrepareOptions, TrainingShapeOptions
from notecodes.functions.prompts import completion_text
from notecodes.operators.checks import require_not_empty, require_template
from notecodes.operators.split import limit_first
from notecodes.plans.prepare import load_or_prepare
from notecodes.sources.io import write_jsonl


def add_prompt_completion(df: DataFrame, opts: TrainingShapeOptions = TrainingShapeOptions()) -> DataFrame:
    """P12 + P15: ``prompt``, ``completion`` and the completion's character span."""
    out = df.withColumns({
        "prompt": F.col("prompt_text"),
        "completion": completion_text(F.col("target_text"), opts.template),
    })
    return out.withColumns({"loss_start": F.length("prompt"), "loss_len": F.length("completion")})


def training_views(spark: SparkSession, raw: DataFrame, prepared_dir: str,
                   prep: PrepareOptions = PrepareOptions(),
                   opts: TrainingShapeOptions = TrainingShapeOptions()) -> tuple[DataFrame, DataFrame]:
    """Train and validation views, limited and with prompt/completion columns.

    A table built here also saves its report, beside it. Raises when the train view is empty (F9) or a row lacks the response
    template (F8, checked on every row).
    """
    table = load_or_prepare(spark, raw, prepared_dir, prep, report_path=prepared_dir.rstrip("/") + "_report.json")
    train = add_prompt_completion(limit_first(table.where(F.col("split") == "train"), opts.max_train_samples), opts)
    val = add_prompt_completion(limit_first(table.where(F.col("split") == "validation"), opts.max_eval_samples), opts)
    require_not_empty(train, "Training dataset")
    require_template(train, opts.template)
    return train, val


def write_training_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    cols = ["example_id", "prompt", "completion", "text", "loss_start", "loss_len"]
    if fmt == "jsonl":
        write_jsonl(df.select(*cols), path)
    else:
        df.select(*cols).write.mode("overwrite").parquet(path)
