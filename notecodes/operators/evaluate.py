"""Evaluation: join predictions to references, per-row and overall set metrics.

Codes of each prediction and reference are extracted once; macro and micro
metrics come from one aggregation (partial sums map-side, one tiny shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notecodes.functions.codes import extract_codes
from notecodes.functions.metrics import METRIC_COLUMNS, example_metrics, true_positives

MACRO = ("precision", "recall", "f1", "exact_match")
COUNT_MEANS = ("num_predicted_codes", "num_reference_codes")
MICRO = ("micro_precision", "micro_recall", "micro_f1")
EVALUATION_FIELDS = MACRO + COUNT_MEANS + MICRO


def pair_predictions(references: DataFrame, predictions: DataFrame, key: str = "example_id") -> DataFrame:
    """References joined to predictions by id (the reference zips two lists).

    ``references`` needs ``key`` and ``target_text``; ``predictions`` needs
    ``key`` and ``prediction``. Both sides are shuffled by id (ids are unique,
    so there is no skew); AQE turns it into a broadcast join when a side is
    small at run time.
    """
    return references.join(predictions.select(key, "prediction"), key, "inner")


def prediction_gaps(references: DataFrame, predictions: DataFrame, key: str = "example_id") -> DataFrame:
    """one row of counts: rows on either side, ids without a prediction or a
    reference, and ids that a side has more than once. Any gap or repeat means
    that the two sides do not pair one to one.

    Ids are counted per side before the join, so a repeated id (hot or not) is
    one row there.
    """
    r = references.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    p = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("_p"))
    both = r.join(p, key, "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return both.agg(
        total("_r").alias("references"),
        total("_p").alias("predictions"),
        F.count_if(F.col("_p").isNull()).cast("bigint").alias("missing_predictions"),
        F.count_if(F.col("_r").isNull()).cast("bigint").alias("extra_predictions"),
        F.count_if(F.col("_r") > 1).cast("bigint").alias("repeated_references"),
        F.count_if(F.col("_p") > 1).cast("bigint").alias("repeated_predictions"),
    )


def require_aligned(references: DataFrame, predictions: DataFrame, key: str = "example_id") -> None:
    """Raise when predictions and references do not pair one to one."""
    row = prediction_gaps(references, predictions, key).first()
    faults = {k: row[k] for k in ("missing_predictions", "extra_predictions", "repeated_references", "repeated_predictions") if row[k]}
    if faults:
        raise ValueError("No one-to-one pairing by id: " + ", ".join(f"{n} {k.replace('_', ' ')}" for k, n in faults.items()))


def paired_once(known: DataFrame, predictions: DataFrame, asked: Column, key: str = "example_id",
                columns: Sequence[str] = ("prompt_text", "target_text")) -> DataFrame:
    """J1 and F12 in one pass over each side: ``known`` (all rows of the prepared table) met with the predictions.

    ``asked`` says which known rows are evaluated. One full outer join by id gives every asked row and every
    prediction that belongs to no known row, with ``_asked`` (null for a stranger) and ``_predictions`` (how
    often the id is predicted, null if never). Only asked rows carry their ``columns``. A repeated id is
    one row before the join.
    """
    left = known.select(key, asked.alias("_asked"), *(F.when(asked, F.col(c)).alias(c) for c in columns))
    right = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("_predictions"), F.min("prediction").alias("prediction"))
    return left.join(right, key, "full_outer").where(F.coalesce("_asked", F.lit(True)))


def require_paired(met: DataFrame, key: str = "example_id") -> None:
    """Raise unless the rows of ``paired_once`` (read from a written table) pair one to one."""
    per_id = met.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.first("_asked").alias("asked"), F.first("_predictions").alias("predictions"))
    row = per_id.agg(
        F.count_if(F.col("asked").isNull()).alias("strangers"), F.count_if(F.col("asked") & F.col("predictions").isNull()).alias("missing"),
        F.count_if(F.col("asked") & (F.col("predictions") > 1)).alias("repeated"), F.count_if(F.col("rows") > 1).alias("references"),
    ).first()
    if row["strangers"]:
        raise ValueError(f"{row['strangers']} predictions have an id that the prepared table does not have.")
    faults = [f"{row[c]} {what}" for c, what in (("missing", "missing predictions"), ("references", "repeated references"), ("repeated", "repeated predictions")) if row[c]]
    if faults:
        raise ValueError("No one-to-one pairing by id: " + ", ".join(faults))


def with_code_sets(pairs: DataFrame, prediction: str = "prediction", reference: str = "target_text") -> DataFrame:
    return pairs.withColumns({"pred_codes": extract_codes(F.col(prediction)), "ref_codes": extract_codes(F.col(reference))})


def example_metric_rows(pairs: DataFrame, prediction: str = "prediction", reference: str = "target_text") -> DataFrame:
    """M1 per row: adds the six metric columns and ``true_positives``."""
    coded = with_code_sets(pairs, prediction, reference)
    m = example_metrics(F.col("pred_codes"), F.col("ref_codes"))
    return coded.withColumns({**m, "true_positives": true_positives(F.col("pred_codes"), F.col("ref_codes")).cast("double")})


def evaluation_aggregates(per_row: DataFrame, by: Sequence[str] = (), with_total: bool = False) -> DataFrame:
    """Macro means, micro P/R/F1 and row count, per group or overall.

    ``with_total`` adds the overall row (group columns NULL) in the same
    aggregation (``rollup``), so per-split and overall metrics cost one pass.
    Empty input: the seven rate fields are 0.0 and the two count means stay
    NULL, as the reference returns them only when there are rows.
    """
    sums = [F.avg(c).alias(c) for c in MACRO + COUNT_MEANS] + [
        F.sum("true_positives").alias("_tp"),
        F.sum("num_predicted_codes").alias("_np"),
        F.sum("num_reference_codes").alias("_nr"),
        F.count(F.lit(1)).cast("bigint").alias("num_examples"),
    ]
    if by and with_total:
        agg = per_row.rollup(*by).agg(*sums)
    else:
        agg = per_row.groupBy(*by).agg(*sums) if by else per_row.agg(*sums)

    def ratio(num: Column, den: Column) -> Column:
        return F.when(F.coalesce(den, F.lit(0.0)) > 0, num / den).otherwise(F.lit(0.0))

    mp = ratio(F.col("_tp"), F.col("_np"))
    mr = ratio(F.col("_tp"), F.col("_nr"))
    out = agg.withColumns({"micro_precision": mp, "micro_recall": mr})
    out = out.withColumn(
        "micro_f1",
        F.when(F.col("micro_precision") + F.col("micro_recall") == 0, F.lit(0.0)).otherwise(
            F.lit(2.0) * F.col("micro_precision") * F.col("micro_recall") / (F.col("micro_precision") + F.col("micro_recall"))
        ),
    )
    for c in MACRO:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return out.select(*by, *EVALUATION_FIELDS, "num_examples")


def evaluate(references: DataFrame, predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """J1 -> M1 -> A9 in one plan."""
    return evaluation_aggregates(example_metric_rows(pair_predictions(references, predictions)), by)


def prediction_records(pairs: DataFrame) -> DataFrame:
    """``example_id, prompt_text, reference, prediction``."""
    return pairs.select("example_id", "prompt_text", F.col("target_text").alias("reference"), "prediction")


__all__ = [
    "METRIC_COLUMNS", "EVALUATION_FIELDS", "pair_predictions", "prediction_gaps", "require_aligned", "paired_once", "require_paired",
    "example_metric_rows", "evaluation_aggregates", "evaluate", "prediction_records",
]
