"""Evaluate and training-shape jobs, row numbering of file sources, tokenizer plug point."""

from __future__ import annotations

import json
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from notecodes.config import EvaluateOptions, PrepareOptions, TrainingShapeOptions
from notecodes.functions.tokens import approx_token_count, tokenizer_count_udf
from notecodes.operators import clean
from notecodes.plans.evaluate_job import evaluation_rows, read_metrics, run_evaluation
from notecodes.plans.prepare import prepare
from notecodes.plans.training import training_views, write_training_table
from notecodes.session import scratch_path
from notecodes.sources import fixtures, io
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def prepared(spark):
    out = scratch_path(spark, "jobs-prepared")
    prepare(spark, fixtures.raw_examples(spark, SF0001), out, PrepareOptions())
    return out


def test_evaluate_job_with_predictor(spark, prepared):
    out = scratch_path(spark, "eval") + "/preds.jsonl"
    m = run_evaluation(spark, prepared, out, EvaluateOptions(split="test", max_samples=5)).first()
    assert m.num_examples == 5
    back = read_metrics(spark, out).first()
    assert back.split == "test" and back.num_examples == 5 and back.model_id == "rule-predictor"
    assert spark.read.json(out).count() == 5


def test_evaluate_job_runs_the_predictor_once(spark, prepared):
    # A sampling predictor answers differently on every run: the written
    # predictions agree with the metrics only if it ran once.
    def _random_predictor(options):
        import random

        return lambda prompts: [random.choice(["E11.9", "I10", ""]) for _ in prompts]

    out = scratch_path(spark, "eval-once") + "/preds.jsonl"
    m = run_evaluation(spark, prepared, out, EvaluateOptions(split="train", max_samples=None),
                       factory=_random_predictor).first()
    written = spark.read.json(out).withColumn("_np", (F.col("prediction") != "").cast("double"))
    got = written.agg(F.count(F.lit(1)).alias("n"), F.avg("_np").alias("np")).first()
    assert got.n == m.num_examples > 50
    assert abs(got.np - m.num_predicted_codes) < 1e-12


def test_evaluate_job_with_predictions_table(spark, prepared):
    table = spark.read.parquet(prepared).where(F.col("split") == "validation")
    preds = table.select("example_id", F.col("target_text").alias("prediction"))
    rows = evaluation_rows(spark, prepared, EvaluateOptions(split="validation", max_samples=None), predictions=preds)
    agg = rows.agg(F.avg("exact_match").alias("em"), F.count(F.lit(1)).alias("n")).first()
    assert agg.em == 1.0 and agg.n == 8


def test_training_views(spark, prepared):
    train, val = training_views(spark, fixtures.raw_examples(spark, SF0001), prepared, PrepareOptions(),
                                TrainingShapeOptions(max_train_samples=100))
    assert train.count() == 100 and val.count() == 8
    bad = train.where(F.concat("prompt", "completion") != F.col("text")).count()
    assert bad == 0
    path = scratch_path(spark, "train-jsonl")
    write_training_table(train, path, "jsonl")
    assert spark.read.json(path).count() == 100


def test_training_view_refuses_empty(spark, prepared):
    with pytest.raises(ValueError):
        training_views(spark, fixtures.raw_examples(spark, SF0001), prepared, PrepareOptions(),
                       TrainingShapeOptions(max_train_samples=0))


def test_row_no_follows_file_order(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select(
        F.col("doc_id"), F.col("text").alias("ehr_text"), F.lit("x").alias("instruction"),
        F.lit("E11.9").alias("output"), F.lit(None).cast("string").alias("icd_code"))
    path = scratch_path(spark, "raw-multi")
    docs.orderBy("doc_id").repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    raw = io.read_raw(spark, path)
    got = sorted(raw.select("row_no", "doc_id").collect())
    assert [r.doc_id for r in got] == list(range(200)) and len({r.row_no for r in got}) == 200


def test_tokenizer_plug_point(spark):
    df = spark.createDataFrame([("a b  c",), ("",), (None,)], "t string")
    count = tokenizer_count_udf(lambda: (lambda texts: [t.split() for t in texts]))
    rows = df.select(count(F.col("t")).alias("n"), approx_token_count(F.col("t")).alias("a")).collect()
    assert [r.n for r in rows] == [3, 0, 0]
    assert [r.a for r in rows] == [3, 0, 0]


def test_rejects_and_stats_agree(spark):
    c = clean.classify(fixtures.raw_examples(spark, SF0001))
    stats = {r.stat: r.n for r in clean.cleaning_stats(c).collect()}
    by_reason = {r.reject_reason: r["count"] for r in clean.rejects(c).groupBy("reject_reason").count().collect()}
    for reason, n in by_reason.items():
        assert stats[reason] == n


def test_batch_inference_job(spark):
    from notecodes.plans.score_job import run_batch_inference

    src = scratch_path(spark, "notes-src")
    io.write_jsonl(fixtures.notes_table(spark, SF0001).select("note", "instruction"), src)
    with pytest.raises(ValueError):
        run_batch_inference(spark, src, None)
    q = scratch_path(spark, "quarantine")
    out = run_batch_inference(spark, src, scratch_path(spark, "scored"), quarantine_path=q)
    n_bad = spark.read.json(q).count()
    assert out.count() + n_bad == 200 and n_bad > 0
    assert out.where(F.col("normalized_prediction") != "").count() > 0


def test_read_raw_json_picks_one_split(spark):
    path = scratch_path(spark, "raw-json")
    rows = [("note a", None, "Codes: E11.9", None, "train"), ("note b", "x", None, "I10", "test"),
            ("note c", None, "K21.9", None, "train")]
    df = spark.createDataFrame(rows, "ehr_text string, instruction string, output string, icd_code string, split string")
    io.write_jsonl(df, path)
    raw = io.read_raw(spark, path, fmt="json", split="train")
    assert sorted(r.ehr_text for r in raw.collect()) == ["note a", "note c"]
    assert raw.select("row_no").distinct().count() == 2


def test_row_no_follows_file_order_for_json_blocks(spark):
    # Files of unequal size split into many blocks: Spark packs blocks by size,
    # not path, so numbering must come from (file, block start, position).
    import json
    import os

    path = scratch_path(spark, "raw-json-blocks")
    os.makedirs(path, exist_ok=True)
    n = 0
    for fi, k in enumerate([5, 300, 40, 120]):
        with open(f"{path}/part-{fi:02d}.json", "w") as f:
            for r in range(k):
                f.write(json.dumps({"ehr_text": f"row {n}", "output": "E11.9", "split": "test" if n % 3 == 0 else "train"}) + "\n")
                if r % 17 == 0:
                    f.write("\n")  # blank lines are skipped
                n += 1
    with io.session_conf(spark, "spark.sql.files.maxPartitionBytes", "2000"):
        got = io.read_raw(spark, path, fmt="json").select("row_no", "ehr_text").collect()
        assert [r.ehr_text for r in sorted(got)] == [f"row {i}" for i in range(n)] and len({r.row_no for r in got}) == n
        plan = io.read_raw(spark, path, fmt="json")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange hashpartitioning" not in plan and "Window" not in plan
        # the split filter runs after numbering: row_no is the same as without it
        number = {r.ehr_text: r.row_no for r in got}
        test_rows = io.read_raw(spark, path, fmt="json", split="test").select("row_no", "ehr_text").collect()
        assert len(test_rows) == (n + 2) // 3 and all(number[r.ehr_text] == r.row_no for r in test_rows)


def test_row_no_without_room_is_an_error(spark, tmp_path, monkeypatch):
    spark.range(2000).selectExpr("concat('row ', id) ehr_text").coalesce(1).write.json(str(tmp_path / "a"))
    spark.range(2000).selectExpr("concat('row ', id) ehr_text").coalesce(1).write.mode("append").json(str(tmp_path / "a"))
    monkeypatch.setattr(io, "_ROW_BITS", 61)  # leaves two blocks a file
    with io.session_conf(spark, "spark.sql.files.maxPartitionBytes", "4000"):
        with pytest.raises(Exception, match="No room"):
            io.read_raw(spark, str(tmp_path / "a"), "json").agg(F.max("row_no")).collect()


def test_row_no_with_odd_paths(spark, tmp_path):
    path = str(tmp_path / "a b+c%20ü")
    spark.range(5).selectExpr("cast(id as string) ehr_text").coalesce(1).write.json(path)
    assert [r.ehr_text for r in io.read_raw(spark, path, "json").orderBy("row_no").collect()] == list("01234")


def test_predictor_sees_each_note_once_and_in_order(spark, tmp_path):
    from notecodes.plans.score_job import run_batch_inference, run_folder_inference

    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    def counting(options):
        def predict(prompts):
            with open(f"{calls}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(re.search(r"note (\d+) end", p)[1] for p in prompts))
            return ["E11.9"] * len(prompts)
        return predict

    rows = [{"note": f"note {i} end", "instruction": "x"} for i in range(400)]
    src = tmp_path / "in"
    src.mkdir()
    for k in range(4):
        (src / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows[k * 100:(k + 1) * 100]) + "\n")
    (src / "4.json").write_text('{"note": null}\n{"note": "broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        run_batch_inference(spark, str(src), str(tmp_path / "no"))
    bad = str(tmp_path / "bad")
    out = run_batch_inference(spark, str(src), str(tmp_path / "out"), counting, quarantine_path=bad)
    seen = [int(x) for name in os.listdir(calls) for x in open(f"{calls}/{name}").read().split("\n")]
    assert sorted(seen) == list(range(400))
    files = sorted(f for f in os.listdir(tmp_path / "out") if f.startswith("part"))
    written = [json.loads(x)["note"] for f in files for x in open(tmp_path / "out" / f)]
    assert written == [r["note"] for r in rows] and out.count() == 400
    got = spark.read.schema("broken_line string, violations array<string>").json(bad).collect()
    assert sorted((list(r.violations), r.broken_line) for r in got) == [(["json"], '{"note": "broken'), (["note"], None)]

    folder = tmp_path / "notes"
    folder.mkdir()
    for i in range(7):
        (folder / f"{i}.txt").write_text(f"note {i} end\nE11.9")
    scored = run_folder_inference(spark, str(folder), str(tmp_path / "scored"))
    assert [(r.path.rsplit("/", 1)[1], r.normalized_prediction) for r in sorted(scored.collect())] == [(f"{i}.txt", "E11.9") for i in range(7)]


def test_prompts_are_cut_and_flagged(spark, tmp_path):
    from notecodes.config import PredictOptions
    from notecodes.functions.tokens import approx_cut
    from notecodes.operators.score import batch_predict

    assert approx_cut("a b, c", 3) == ("a b,", True) and approx_cut("a b, c", 4) == ("a b, c", False) and approx_cut("", 2) == ("", False)
    df = spark.createDataFrame([(1, "one two three four"), (2, "one"), (3, None)], "k int, prompt_text string")
    echo = lambda options: lambda prompts: prompts
    got = batch_predict(df, echo, PredictOptions(max_seq_length=3)).collect()
    assert sorted((r.k, r.prediction, r.was_cut) for r in got) == [(1, "one two three", True), (2, "one", False), (3, "", False)]
    raw = fixtures.raw_examples(spark, SF0001)
    out = str(tmp_path / "prepared")
    prepare(spark, raw, out)
    rows = evaluation_rows(spark, out, EvaluateOptions(split="train", max_seq_length=200))
    assert {r.was_cut for r in rows.select("was_cut").distinct().collect()} == {True, False}


def test_reuse_by_content(spark, tmp_path):
    from notecodes.plans import prepare as job

    src, out = str(tmp_path / "raw"), str(tmp_path / "prepared")
    fixtures.raw_examples(spark, SF0001).drop("row_no").withColumn("split", F.lit("train")).write.parquet(src)
    built = []
    prepare_once = job.prepare
    job.prepare = lambda *a, **k: built.append(1) or prepare_once(*a, **k)
    try:
        splits = lambda opts: {(r.example_id, r.split) for r in job.load_or_prepare_source(spark, src, out, opts=opts).select("example_id", "split").collect()}
        first = splits(PrepareOptions())
        assert splits(PrepareOptions()) == first and len(built) == 1
        assert spark.read.text(out + "_report.json").count() == 1
        assert splits(PrepareOptions(output_compression="snappy")) == first and len(built) == 1  # same rows
        other = splits(PrepareOptions(seed=7))
        assert other != first and len(built) == 2  # changed options build anew
        fixtures.raw_examples(spark, SF0001).drop("row_no").limit(50).withColumn("split", F.lit("train")).write.mode("append").parquet(src)
        splits(PrepareOptions(seed=7))
        assert len(built) == 3  # so does a changed source
        os.remove(f"{out}/_manifest.json")  # a run that broke before its end
        splits(PrepareOptions(seed=7))
        assert len(built) == 4
    finally:
        job.prepare = prepare_once


def test_rebalanced_write_follows_bytes(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "repeat(cast(id as string), 50) text", "case when id % 20 = 0 then 'test' when id % 20 = 1 then 'validation' else 'train' end split").repartition(40)
    files = lambda p: {s: sum(f.startswith("part") for f in os.listdir(f"{p}/split={s}")) for s in ("train", "validation", "test")}
    io.save_splits(rows, str(tmp_path / "a"))
    io.save_splits(rows, str(tmp_path / "b"), rebalance=True)
    assert min(files(tmp_path / "a").values()) > 30
    assert files(tmp_path / "b") == {"train": 1, "validation": 1, "test": 1}
    with io.session_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k"):
        io.save_splits(rows, str(tmp_path / "c"), rebalance=True)
    got = files(tmp_path / "c")
    assert got["train"] > 2 * got["test"] and got["test"] <= 2
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4000


def test_key_at_rank_on_uneven_and_equal_keys(spark):
    from notecodes.operators import profile, split

    rows = spark.range(60_000).selectExpr("case when id = 59999 then 1000000000000 when id < 20000 then 7 else id end k")
    keys = sorted(r.k for r in rows.collect())
    for n in (1, 20_000, 20_001, 40_000, 59_999, 60_000):
        assert split.key_at_rank(rows, n, F.col("k"), most=500) == keys[n - 1], n
    assert split.key_at_rank(rows, 60_001, F.col("k"), most=500) is None
    assert split.key_at_rank(rows.where("k < 0"), 1, F.col("k")) is None
    far = spark.range(5000).selectExpr("case when id = 4999 then 1000000000000 else id end row_no")
    for n in (1, 2500, 4999, 5000, 9000):
        assert profile.up_to_rank(far, n, "row_no", most=50).count() == min(n, 5000)


def test_length_batches(spark):
    from notecodes.config import BatchOptions
    from notecodes.operators import checks

    rows = spark.range(103).selectExpr("concat('id', id) example_id", "repeat('x ', cast(id % 9 as int)) text")
    got = checks.length_batches(rows, BatchOptions(batch_size=4, mega_batches=5)).collect()
    assert len(got) == 103 and len({r.example_id for r in got}) == 103
    batches = {}
    for r in got:
        batches.setdefault(r.batch, []).append((r.place, r.n_tokens))
    assert sorted(batches) == list(range(26)) and [len(batches[b]) for b in sorted(batches)] == [4] * 25 + [3]
    for mega in range(5):
        inside = [n for b in range(mega * 5, mega * 5 + 5) for _, n in sorted(batches[b])]
        assert inside == sorted(inside, reverse=True)
    assert [r.n_tokens for r in sorted(got, key=lambda r: (r.batch, r.place))][:20] != sorted((r.n_tokens for r in got), reverse=True)[:20]
    again = checks.length_batches(rows.repartition(7), BatchOptions(batch_size=4, mega_batches=5)).collect()
    assert sorted(again) == sorted(got)
    assert checks.length_batches(rows.where("false")).count() == 0


def test_predictions_are_read_once(spark, tmp_path):
    from notecodes.operators import evaluate

    table = prepare(spark, fixtures.raw_examples(spark, SF0001), str(tmp_path / "p")).splits
    preds = str(tmp_path / "preds")
    table.select("example_id", F.col("target_text").alias("prediction")).write.parquet(preds)
    met = evaluate.paired_once(table, spark.read.parquet(preds), F.col("split") == "test")
    assert met._jdf.queryExecution().optimizedPlan().toString().count("prediction#") and met._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_close_removes_the_stage(spark, tmp_path):
    stage = str(tmp_path / "stage")
    done = prepare(spark, fixtures.raw_examples(spark, SF0001), str(tmp_path / "out"), stage_dir=stage)
    assert os.path.isdir(stage)
    done.close()
    assert not os.path.isdir(stage) and done.splits.count() > 0


def test_evaluate_takes_its_part_of_all_predictions(spark, tmp_path):
    """A limited split with predictions of every split; strangers and repeats are errors."""
    raw = fixtures.raw_examples(spark, SF0001)
    out = str(tmp_path / "prepared")
    table = prepare(spark, raw, out).splits
    preds = table.select("example_id", F.col("target_text").alias("prediction"))
    rows = evaluation_rows(spark, out, EvaluateOptions(split="train", max_samples=3), predictions=preds)
    assert rows.count() == 3
    with pytest.raises(ValueError, match="does not have"):
        evaluation_rows(spark, out, EvaluateOptions(split="test"), predictions=preds.withColumn("example_id", F.concat("example_id", F.lit("x"))))
    with pytest.raises(ValueError, match="repeated predictions"):
        evaluation_rows(spark, out, EvaluateOptions(split="test"), predictions=preds.union(preds))


def test_metrics_path_replaces_the_last_suffix():
    assert io.metrics_path("/a/b.c/x.jsonl") == "/a/b.c/x.metrics.json"
    assert io.metrics_path("/a/b.c/x/") == "/a/b.c/x.metrics.json"
    assert io.metrics_path("y.z.jsonl") == "y.z.metrics.json"


def test_read_raw_faults(spark, tmp_path):
    path = str(tmp_path / "raw.json")
    with open(path, "w") as f:
        f.write('{"ehr_text": "a", "split": "train"}\n{"ehr_text": "b", "split": "other"}\n')
    assert [r.ehr_text for r in io.read_raw(spark, path, "json", split="train").collect()] == ["a"]
    with pytest.raises(ValueError, match="no split"):
        io.read_raw(spark, path, "json", split="nowhere")
    plain = str(tmp_path / "plain")
    spark.createDataFrame([("a",)], "ehr_text string").write.parquet(plain)
    with pytest.raises(ValueError, match="no column"):
        io.read_raw(spark, plain, split="train")


def test_byte_strings_of_the_split_size(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(10).selectExpr("cast(id as string) ehr_text").coalesce(1).write.json(path)
    with io.session_conf(spark, "spark.sql.files.maxPartitionBytes", "128m"):
        assert sorted(r.row_no for r in io.read_raw(spark, path, "json").select("row_no").collect()) == list(range(10))


def test_limits_keep_the_first_rows(spark):
    from notecodes.operators import profile, split

    rows = spark.range(500).selectExpr("sha2(cast(id as string), 256) split_key", "id * 7 row_no")
    keys = sorted(r.split_key for r in rows.collect())
    for n in (0, 1, 37, 500, 900):
        assert sorted(r.split_key for r in split.limit_first(rows, n).collect()) == keys[:n]
        assert sorted(r.row_no for r in profile.first_rows(rows, n).collect()) == [7 * i for i in range(min(n, 500))]


def test_stream_quarantines_broken_lines(spark, tmp_path):
    from notecodes.streaming.score_stream import run_stream_once

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"row_no": 1, "note": "E11.9", "num_beams": 2}\n{"row_no": 2, "note": \n')
    quarantine = str(tmp_path / "bad")
    sink = run_stream_once(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), quarantine_dir=quarantine)
    assert [(r.row_no, r.normalized_prediction) for r in sink.collect()] == [(1, "E11.9")]
    assert [(list(r.violations), r.broken_line) for r in spark.read.parquet(quarantine).collect()] == [(["json"], '{"row_no": 2, "note": ')]
