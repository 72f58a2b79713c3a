"""Sources, sinks, checks, scoring and stream = batch."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from notecodes.config import PredictOptions, PrepareOptions
from notecodes.operators import checks, score
from notecodes.plans.prepare import load_or_prepare, prepare
from notecodes.session import BATCH_BYTES, scratch_path
from notecodes.sources import fixtures, io
from notecodes.streaming.score_stream import STREAM_NOTES_SCHEMA, run_stream_once, score_micro_batch
from tests.conftest import SF0001


def test_prepare_writes_partitioned_table_and_report(spark):
    out, rep = scratch_path(spark, "prep"), scratch_path(spark, "report")
    res = prepare(spark, fixtures.raw_examples(spark, SF0001), out, PrepareOptions(), report_path=rep)
    assert {r.split: r["count"] for r in res.splits.groupBy("split").count().collect()} == {
        "train": 136, "validation": 8, "test": 8}
    listed = sorted(f for f in os.listdir(out.replace("file:", "")) if not f.startswith("."))
    assert listed == ["_SUCCESS", "split=test", "split=train", "split=validation"]
    doc = json.loads(io.read_json_document(spark, rep).first().json)
    assert doc["clean_rows"] == 152 and doc["cleaning_stats"]["rows_seen"] == 200
    assert res.rejects.count() == 200 - 152 - 6
    # S3: the second call reuses the table
    again = load_or_prepare(spark, fixtures.raw_examples(spark, SF0001), out)
    assert again.count() == 152
    test_only = io.read_split(spark, out, "test")
    assert "PartitionFilters: [isnotnull(split" in test_only._jdf.queryExecution().executedPlan().toString()


def test_jsonl_roundtrip_keeps_nulls_and_unicode(spark):
    path = scratch_path(spark, "notes")
    df = spark.createDataFrame([("Fièvre — E11.9", None), ("x", "List the codes.")], "note string, instruction string")
    io.write_jsonl(df, path)
    text = "".join(open(os.path.join(path.replace("file:", ""), f), encoding="utf-8").read()
                   for f in os.listdir(path.replace("file:", "")) if f.endswith(".json"))
    assert '"instruction":null' in text and "Fièvre" in text
    back = io.read_notes_jsonl(spark, path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_note_files(spark):
    d = scratch_path(spark, "note-files").replace("file:", "")
    os.makedirs(d)
    for i, t in enumerate(["first note\nline two", "second E11.9 note"]):
        with open(os.path.join(d, f"n{i}.txt"), "w", encoding="utf-8") as h:
            h.write(t)
    got = sorted(r.note for r in io.read_note_files(spark, d).collect())
    assert got == ["first note\nline two", "second E11.9 note"]


def test_request_violations(spark):
    df = spark.createDataFrame(
        [("n", 32, 0.0, 1.0, 1), ("", 0, 2.5, 1.0, 9), (None, 128, 2.0, 0.0, 8)],
        "note string, max_new_tokens int, temperature double, top_p double, num_beams int")
    rows = checks.request_violations(df).collect()
    assert [r.violations for r in rows] == [[], ["max_new_tokens", "temperature", "num_beams"], ["note"]]


def test_token_run_check(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([1, 3],), ([],)], "ids array<int>")
    got = [r.ok for r in df.select(checks.contains_token_run(F.col("ids"), [2, 3]).alias("ok")).collect()]
    assert got == [True, False, False]


def test_stream_equals_batch(spark):
    notes = fixtures.notes_table(spark, SF0001)
    src = scratch_path(spark, "stream-in")
    io.write_jsonl(notes, src)
    quarantine = scratch_path(spark, "stream-bad")
    streamed = run_stream_once(spark, src, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
                               quarantine_dir=quarantine)
    batch = score.score_notes(notes.where(F.col("note").isNotNull()))
    cols = ["row_no", "prompt_text", "raw_prediction", "normalized_prediction"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(streamed.select(cols)).count() == 0
    bad = spark.read.parquet(quarantine)
    assert streamed.count() + bad.count() == 200 and bad.count() > 0
    assert {tuple(r.violations) for r in bad.select("violations").collect()} == {("note",)}
    assert batch.where(F.col("normalized_prediction") != "").count() > 0


def test_custom_predictor_is_built_once_per_task(spark):
    def factory(options):
        return lambda prompts: ["I10"] * len(prompts)

    df = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "example_id int, prompt_text string")
    out = score.batch_predict(df, factory)
    assert {r.prediction for r in out.collect()} == {"I10"}


LONG = 100_000


def long_notes(spark):
    """24 MB of notes in one task, far fewer rows than an Arrow batch may have."""
    return spark.range(240).coalesce(1).select(F.col("id").alias("row_no"), F.concat(F.repeat(F.lit("a"), LONG - 4), F.lpad(F.col("id").cast("string"), 4, "0")).alias("note"),
                                               F.lit(None).cast("string").alias("instruction"))


def chars_at_once():
    """A factory whose predictor answers with the characters of all prompts of the call."""
    return lambda options: lambda prompts: [str(sum(map(len, prompts)))] * len(prompts)


def test_long_rows_of_a_stream_come_in_small_batches(spark):
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in STREAM_NOTES_SCHEMA.fields[3:]]
    sink, quarantine = scratch_path(spark, "long-out"), scratch_path(spark, "long-bad")
    score_micro_batch(long_notes(spark).select("*", *rest), 0, sink, quarantine, chars_at_once(), PredictOptions(batch_size=10_000))
    got = spark.read.parquet(sink).select("row_no", "raw_prediction", F.length("note").alias("n")).collect()
    assert sorted(r.row_no for r in got) == list(range(240)) and {r.n for r in got} == {LONG}
    assert max(int(r.raw_prediction) for r in got) <= BATCH_BYTES + 2 * LONG


def test_a_task_keeps_a_bounded_number_of_predictors(spark):
    class Counted:
        alive = 0

        def __init__(self, options):
            Counted.alive += 1
            self.own = options.max_new_tokens

        def __del__(self):
            Counted.alive -= 1

        def __call__(self, prompts):
            return [f"{self.own} {Counted.alive}"] * len(prompts)

    n = 3 * score.KEPT_PREDICTORS
    rows = spark.range(2 * n).coalesce(1).select((F.col("id") % n).cast("int").alias("max_new_tokens"), F.lit("p").alias("prompt_text"))
    got = [(r.max_new_tokens, *map(int, r.prediction.split())) for r in score.batch_predict(rows, Counted, settings=("max_new_tokens",)).collect()]
    assert len(got) == 2 * n and all(mine == own for mine, own, _ in got)
    assert max(alive for *_, alive in got) <= score.KEPT_PREDICTORS + 1


def test_long_prompts_are_cut_in_small_batches(spark):
    rows_at_once = lambda options: lambda prompts: [f"{p[-1]} {len(p)} {len(prompts)}" for p in prompts]
    prompts = long_notes(spark).select("row_no", F.concat(F.lit("b "), "note").alias("prompt_text"))
    got = score.batch_predict(prompts, rows_at_once, PredictOptions(batch_size=10_000, max_seq_length=1)).select("row_no", "prediction", "was_cut").collect()
    assert sorted(r.row_no for r in got) == list(range(240)) and all(r.was_cut and r.prediction.startswith("b 1 ") for r in got)
    assert max(int(r.prediction.split()[2]) for r in got) <= BATCH_BYTES / LONG + 1


def test_long_prompts_are_predicted_in_small_batches(spark):
    got = score.score_notes(long_notes(spark), chars_at_once(), PredictOptions(batch_size=10_000)).select("row_no", "raw_prediction").collect()
    assert sorted(r.row_no for r in got) == list(range(240))
    assert max(int(r.raw_prediction) for r in got) <= BATCH_BYTES + 2 * LONG


def test_other_columns_come_back_as_they_are(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, CAST(NULL AS INT), 1.50BD, TIMESTAMP'2024-01-02 03:04:05', array('a', NULL), 'E11.9', true),
                      (NULL, 7, NULL, NULL, NULL, NULL, NULL) AS t(k, small, price, at, words, prompt_text, flag)""")
    got = score.batch_predict(df, lambda options: lambda prompts: prompts)
    assert got.schema.fields[:-1] == df.schema.fields and sorted(got.drop("prediction").collect(), key=str) == sorted(df.collect(), key=str)
    assert sorted(r.prediction for r in got.collect()) == ["", "E11.9"]
