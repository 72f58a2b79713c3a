"""Physical-plan shape checks: the properties the scale design relies on."""

from __future__ import annotations

from pyspark.sql import functions as F

from notecodes.operators import checks, clean
from notecodes.sources import fixtures
from tests.conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_classification_runs_once_under_a_filter(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    plan = _plan(c.where(F.col("reject_reason").isNull()))
    # output, icd_code and the F6 re-check of the (short) target: once each
    assert plan.count("regexp_extract_all(upper(") == 3
    assert "Generate inline" in plan


def test_classification_is_lambda_free_and_codegen(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    plan = _plan(c)
    assert "lambdafunction" not in plan
    projects = [line for line in plan.splitlines() if "Project [" in line]
    assert projects and all(line.lstrip("+- :").startswith("*(") for line in projects)


def test_window_dedup_limits_before_the_shuffle(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    plan = _plan(clean.first_seen_window(clean.accepted_rows(c)))
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (later in the string than) the exchange
    assert plan.index("Exchange hashpartitioning(example_id") < plan.rindex("Partial")


def test_dedup_reduces_ids_map_side_and_never_sorts_wide_rows(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    plan = _plan(clean.first_seen(clean.accepted_rows(c)))
    assert "ShuffledHashJoin [example_id" in plan and "LeftSemi, BuildRight" in plan
    assert "partial_min(row_no" in plan  # map-side combine before the id exchange
    assert "Sort [" not in plan


def test_same_rows_as_window_dedup(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    a = clean.first_seen(clean.accepted_rows(c)).select("example_id", "row_no")
    b = clean.first_seen_window(clean.accepted_rows(c)).select("example_id", "row_no")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_never_sorts_or_reshuffles_wide_rows(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    plan = _plan(clean.clean_split_rows(c))
    main = plan.split("Subquery")[0] + plan.split("ShuffledHashJoin")[-1]
    assert "Exchange hashpartitioning(_bucket" not in main  # thresholds run in the subquery
    assert "Sort [" not in main


def test_length_grouping_range_key_has_tie_breaker(spark):
    df = spark.createDataFrame([(str(i), "same length text") for i in range(200)], "example_id string, text string")
    out = checks.group_by_length(df, 4)
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert max(sizes) < 200 and sum(sizes) == 200
