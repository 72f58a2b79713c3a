"""Registered queries over whole inputs: no row limit, no text prefix, no fixed file count."""

from __future__ import annotations

from pyspark.sql import functions as F

from notecodes.config import EvaluateOptions
from notecodes.operators import evaluate
from notecodes.plans import catalog
from notecodes.plans.evaluate_job import read_metrics, run_evaluation
from notecodes.plans.prepare import prepare
from notecodes.sources import fixtures
from tests.conftest import SF001


def test_evaluation_file_covers_the_whole_test_split(spark):
    got = catalog.q_evaluation_file(spark, SF001).collect()
    want = catalog.q_metrics_by_split(spark, SF001).where("split = 'test'")
    n = catalog.splits(spark, SF001).where("split = 'test'").count()
    assert n > 20 and [r.num_examples for r in got] == [n]
    assert got == want.select("split", "num_examples", *evaluate.EVALUATION_FIELDS).collect()


def test_evaluation_limit_with_given_predictions(spark, tmp_path):
    """The limit is an argument: the first rows in split order, metrics written over just these."""
    prepared, out = str(tmp_path / "prepared"), str(tmp_path / "eval" / "test_predictions.jsonl")
    table = prepare(spark, fixtures.raw_examples(spark, SF001), prepared).splits
    given = table.select("example_id", F.col("target_text").alias("prediction"))
    run_evaluation(spark, prepared, out, EvaluateOptions(split="test", max_samples=20), predictions=given)
    assert [r.num_examples for r in read_metrics(spark, out).collect()] == [20]
    first = [r.example_id for r in table.where("split = 'test'").orderBy("split_key").limit(20).collect()]
    assert sorted(r.example_id for r in spark.read.json(out).collect()) == sorted(first)


def test_token_template_and_nested_json_read_whole_texts(spark, monkeypatch):
    late = "word " * 600 + "ab cde " + "word " * 3 + "é"  # the run of lengths (2, 3) is behind 3,000 characters
    rows = spark.createDataFrame([(1, late.strip(), ["E11.9"]), (2, "word " * 700 + "end.", []), (3, "ab cde", None)], "row_no long, ehr_text string, target_codes array<string>")
    monkeypatch.setattr(catalog, "stripped", lambda spark, sf: rows)
    monkeypatch.setattr(catalog, "targets", lambda spark, sf: rows)
    assert {r.row_no: r.has_run for r in catalog.q_token_template(spark, "").collect()} == {1: True, 2: False, 3: True}
    notes = {r.row_no: r.note for r in catalog.q_nested_json(spark, "").collect()}
    assert notes == {r.row_no: r.ehr_text for r in rows.collect()}


def test_note_files_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(catalog, "NOTE_FILE_BYTES", 20_000, raising=False)
    read, seen = catalog.io.read_note_files, []

    def watched(spark, path):
        files = read(spark, path)
        seen.append([len(r.note) for r in files.select("note").collect()])
        return files

    monkeypatch.setattr(catalog.io, "read_note_files", watched)
    for rows in (200, 4_000):
        notes = spark.range(rows).selectExpr("id row_no", "concat('n', id, repeat(' x', 200)) note")
        monkeypatch.setattr(catalog.fixtures, "notes_table", lambda spark, sf, notes=notes: notes)
        got = {r.row_no: r.note for r in catalog.q_note_files(spark, "").collect()}
        assert got == {r.row_no: r.note for r in notes.collect()}
    assert len(seen[1]) >= 10 * len(seen[0]) and max(seen[1]) < 60_000
