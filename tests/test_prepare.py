"""Cleaning counts, split sizes and invariants against FIXTURES.md section 2."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from notecodes.config import PrepareOptions
from notecodes.operators import clean, split
from notecodes.sources import fixtures
from tests.conftest import SF0001, SF001

EXPECTED_STATS = {
    SF0001: dict(rows_seen=200, empty_ehr_text=11, empty_target_text=8, label_leakage_in_ehr_text=8,
                 label_leakage_in_prompt=15, duplicate_rows=6, rows_kept=152, label_mismatches=20),
    SF001: dict(rows_seen=1000, empty_ehr_text=51, empty_target_text=46, label_leakage_in_ehr_text=41,
                label_leakage_in_prompt=66, duplicate_rows=49, rows_kept=747, label_mismatches=102),
}
EXPECTED_SPLITS = {SF0001: (136, 8, 8), SF001: (672, 37, 38)}


@pytest.fixture(scope="module")
def classified(spark):
    return {sf: clean.classify(fixtures.raw_examples(spark, sf)) for sf in (SF0001, SF001)}


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_cleaning_stats(classified, sf):
    got = {r.stat: r.n for r in clean.cleaning_stats(classified[sf]).collect()}
    assert got == EXPECTED_STATS[sf]
    assert "invalid_training_text" not in got  # F6 never fires; absent, not 0


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_statuses_sum_to_rows_seen(classified, sf):
    c = classified[sf]
    by = {r.reason: r.n for r in c.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reason")).count()
          .withColumnRenamed("count", "n").collect()}
    assert sum(by.values()) == EXPECTED_STATS[sf]["rows_seen"]


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_split_sizes_and_invariants(classified, sf):
    s = clean.clean_split_rows(classified[sf])
    sizes = {r.split: r.n for r in split.split_counts(s).collect()}
    assert (sizes["train"], sizes["validation"], sizes["test"]) == EXPECTED_SPLITS[sf]
    inv = {r.check: r.n for r in split.split_invariants(s).collect()}
    assert inv["ids_in_two_splits"] == 0
    assert inv["total_rows"] == inv["rows_in_splits"] == inv["distinct_ids"] == sum(sizes.values())


def test_split_matches_plain_global_rank(classified):
    s = clean.clean_split_rows(classified[SF001])
    ranked = split.global_rank(s)
    n_train, n_val, _ = EXPECTED_SPLITS[SF001]
    bad = ranked.where(
        ((F.col("split_rank") <= n_train) & (F.col("split") != "train"))
        | ((F.col("split_rank") > n_train) & (F.col("split_rank") <= n_train + n_val) & (F.col("split") != "validation"))
        | ((F.col("split_rank") > n_train + n_val) & (F.col("split") != "test"))
    ).count()
    assert bad == 0


def _sizes(n, opts=PrepareOptions()):
    hold = opts.val_ratio + opts.test_ratio
    holdout = math.ceil(round(hold * n, 6))
    test = math.ceil(round(opts.test_ratio / hold * holdout, 6))
    return n - holdout, holdout - test, test


def test_split_size_rule_reproduces_published_sizes(spark):
    assert _sizes(229141) == (206226, 11457, 11458)
    df = spark.createDataFrame([(229141,)], "n bigint")
    sz = split.split_sizes(F.col("n"), PrepareOptions())
    row = df.select(*[v.alias(k) for k, v in sz.items()]).first()
    assert (row.n_train, row.n_validation, row.n_test) == (206226, 11457, 11458)


def test_ratio_check():
    with pytest.raises(ValueError):
        PrepareOptions(train_ratio=0.8).check()


def test_same_result_with_1_and_16_partitions(spark):
    raw = fixtures.raw_examples(spark, SF001)
    a = clean.clean_split_rows(clean.classify(raw.coalesce(1))).select("example_id", "split", "row_no")
    b = clean.clean_split_rows(clean.classify(raw.repartition(16))).select("example_id", "split", "row_no")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_kept_ids_unique_and_first_seen(classified):
    s = clean.clean_rows(classified[SF001])
    assert s.count() == s.select("example_id").distinct().count()
    acc = classified[SF001].where(F.col("reject_reason").isNull())
    first = acc.groupBy("example_id").agg(F.min("row_no").alias("row_no"))
    assert s.select("example_id", "row_no").exceptAll(first).count() == 0


def test_training_text_ends_with_target(classified):
    s = clean.clean_rows(classified[SF0001])
    bad = s.where(~F.col("text").endswith(F.concat(F.col("target_text"), F.lit("<|eot_id|>")))).count()
    assert bad == 0
    assert s.where(~F.col("text").startswith(F.col("prompt_text"))).count() == 0
