"""Per-row set metrics between a predicted and a reference code array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metric names.
METRIC_COLUMNS = ("precision", "recall", "f1", "exact_match", "num_predicted_codes", "num_reference_codes")


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def example_metrics(pred_codes: Column, ref_codes: Column) -> dict[str, Column]:
    """Precision, recall, F1, exact match and set sizes, all doubles.

    Inputs are distinct code arrays, so sizes are set sizes. A zero denominator
    gives 0.0; two empty sets give exact match 1.0 and F1 0.0.
    """
    n_pred = F.size(pred_codes)
    n_ref = F.size(ref_codes)
    tp = F.size(F.array_intersect(pred_codes, ref_codes))
    precision = _ratio(tp, n_pred)
    recall = _ratio(tp, n_ref)
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(F.lit(2.0) * precision * recall / (precision + recall))
    exact = F.when((tp == n_pred) & (tp == n_ref), F.lit(1.0)).otherwise(F.lit(0.0))
    return {
        "precision": precision,
        "recall": recall,
        "f1": f1,
        "exact_match": exact,
        "num_predicted_codes": n_pred.cast("double"),
        "num_reference_codes": n_ref.cast("double"),
    }


def true_positives(pred_codes: Column, ref_codes: Column) -> Column:
    return F.size(F.array_intersect(pred_codes, ref_codes))
