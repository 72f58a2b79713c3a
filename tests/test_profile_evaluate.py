"""Summaries, percentiles and evaluation metrics against FIXTURES.md goldens."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from notecodes.operators import clean, evaluate, profile
from notecodes.sources import fixtures
from tests.conftest import SF0001


def _py_percentile(values, p):
    s = sorted(values)
    return float(s[min(len(s) - 1, round(p / 100 * (len(s) - 1)))])


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6, 7, 8], [5], [3, 3, 1, 9, 9, 9, 2]])
def test_nearest_rank_half_even(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    row = profile.numeric_summary(df, "v").first()
    for p in (50, 90, 95, 99):
        assert row[f"p{p}"] == _py_percentile(values, p)
    assert row["mean"] == sum(values) / len(values)
    assert row["count"] == float(len(values))


def test_percentile_index_examples(spark):
    # n = 6, p50 -> round(2.5) = 2; n = 8, p50 -> round(3.5) = 4
    assert profile.numeric_summary(spark.createDataFrame([(v,) for v in range(6)], "v int"), "v").first().p50 == 2.0
    assert profile.numeric_summary(spark.createDataFrame([(v,) for v in range(8)], "v int"), "v").first().p50 == 4.0


def test_empty_summary_has_no_row(spark):
    assert profile.numeric_summary(spark.createDataFrame([], "v int"), "v").count() == 0


@pytest.fixture(scope="module")
def clean_rows(spark):
    return clean.clean_rows(clean.classify(fixtures.raw_examples(spark, SF0001)))


def test_note_length_summary_golden(clean_rows):
    s = profile.first_rows(clean_rows, 1000).select(F.length("ehr_text").alias("n"))
    row = profile.numeric_summary(s, "n").first()
    assert row.asDict() == {
        "count": 152.0, "min": 11.0, "max": 16621.0, "mean": 2261.0723684210525,
        "p50": 1482.0, "p90": 4186.0, "p95": 5530.0, "p99": 12901.0,
    }


def test_evaluation_golden(clean_rows):
    preds = fixtures.fixture_predictions(clean_rows)
    per_row = evaluate.example_metric_rows(evaluate.pair_predictions(clean_rows, preds))
    row = evaluate.evaluation_aggregates(per_row).first()
    assert row.precision == pytest.approx(0.690789474, abs=1e-9)
    assert row.recall == pytest.approx(0.730263158, abs=1e-9)
    assert row.f1 == pytest.approx(0.691885965, abs=1e-9)
    assert row.exact_match == pytest.approx(0.513157895, abs=1e-9)
    assert row.num_predicted_codes == pytest.approx(1.157894737, abs=1e-9)
    assert row.num_reference_codes == pytest.approx(1.355263158, abs=1e-9)
    assert row.micro_precision == pytest.approx(144 / 176)
    assert row.micro_recall == pytest.approx(144 / 206)
    assert row.num_examples == 152
    for c in evaluate.EVALUATION_FIELDS:
        if not c.startswith("num_"):
            assert 0.0 <= row[c] <= 1.0


def test_empty_evaluation(spark):
    refs = spark.createDataFrame([], "example_id string, target_text string")
    preds = spark.createDataFrame([], "example_id string, prediction string")
    row = evaluate.evaluate(refs, preds).first()
    for c in ("precision", "recall", "f1", "exact_match", "micro_precision", "micro_recall", "micro_f1"):
        assert row[c] == 0.0
    assert row.num_predicted_codes is None and row.num_reference_codes is None


def test_prediction_gaps(spark):
    refs = spark.createDataFrame([("a", "I10"), ("b", "E11.9")], "example_id string, target_text string")
    preds = spark.createDataFrame([("a", "I10"), ("c", "x")], "example_id string, prediction string")
    row = evaluate.prediction_gaps(refs, preds).first()
    assert (row.missing_predictions, row.extra_predictions) == (1, 1)
    with pytest.raises(ValueError):
        evaluate.require_aligned(refs, preds)


def test_report_row(spark, clean_rows):
    raw = fixtures.raw_examples(spark, SF0001)
    c = clean.classify(raw)
    rep = profile.dataset_report(raw, clean.clean_split_rows(c), clean.cleaning_stats(c), 1000).first()
    assert rep.raw_rows == 200 and rep.clean_rows == 152
    assert rep.splits == {"train": 136, "validation": 8, "test": 8}
    assert rep.cleaning_stats["rows_kept"] == 152
    assert rep.sample_size_for_report == 152
    assert len(rep.instruction_preview) == 3
    assert rep.num_codes_per_example["count"] == 152.0


def test_rollup_total_equals_overall(clean_rows):
    preds = fixtures.fixture_predictions(clean_rows)
    per_row = evaluate.example_metric_rows(evaluate.pair_predictions(clean_rows.withColumn(
        "split", F.when(F.col("row_no") % 2 == 0, "a").otherwise("b")), preds))
    rows = evaluate.evaluation_aggregates(per_row, by=["split"], with_total=True).collect()
    total = [r for r in rows if r.split is None][0]
    overall = evaluate.evaluation_aggregates(per_row).first()
    assert len(rows) == 3 and total.num_examples == overall.num_examples == 152
    for c in evaluate.EVALUATION_FIELDS:
        assert total[c] == pytest.approx(overall[c], abs=1e-12)


def test_summary_of_many_distinct_values(spark, monkeypatch):
    """A continuous column of as many values as rows, and uneven ones: equal to a plain nearest rank, no window over all values."""
    import math

    from notecodes.operators import profile

    monkeypatch.setattr(profile.summary_of_counts, "__defaults__", ((), profile.PERCENTILES, 100))
    rows = spark.range(5000).selectExpr("id % 2 g", "case when id % 2 = 0 then sin(id) * id else (id div 10) * 1.0 end v", "cast(id as double) * id * id w")
    data = rows.collect()

    def want(values):
        values, n = sorted(values), len(values)
        return [n, values[0], values[-1], math.fsum(values) / n] + [values[min(n - 1, round(p / 100 * (n - 1)))] for p in profile.PERCENTILES]

    got = {r.g: list(r)[1:] for r in profile.numeric_summary(rows, "v", ["g"]).collect()}
    for g in (0, 1):
        assert got[g] == pytest.approx(want([r.v for r in data if r.g == g]), rel=1e-12)
    assert list(profile.numeric_summary(rows, "w").first()) == pytest.approx(want([r.w for r in data]))
    assert profile.numeric_summary(rows.where("false"), "w").count() == 0
    plan = profile.numeric_summary(rows, "w")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert any("_part" in line for line in windows) and not any("sum(_c" in line and "_part" not in line for line in windows)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1000])
def test_summary_of_few_and_equal_values(spark, n):
    from notecodes.operators import profile

    rows = spark.range(n).selectExpr("cast(id % 3 as int) v")
    got = profile.numeric_summary(rows, "v").first()
    assert got == profile.summary_in_parts(profile.value_counts(rows, "v")).first()
    values = sorted(r.v for r in rows.collect())
    assert [got[f"p{p}"] for p in profile.PERCENTILES] == [values[min(n - 1, round(p / 100 * (n - 1)))] for p in profile.PERCENTILES]
    assert got["count"] == n and got["min"] == values[0] and got["max"] == values[-1]
