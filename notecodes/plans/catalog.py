"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the fixture views derived from
``documents``) and runs over whole tables. Arrays are returned as ``|``-joined
strings and averaged doubles are rounded to 9 places, so results compare
exactly with the DuckDB oracle in ``notecodes.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notecodes.config import PredictOptions, PrepareOptions
from notecodes.functions.codes import code_variants, extract_codes, leaks, leaks_in_upper, normalize_code
from notecodes.functions.prompts import DEFAULT_TEMPLATE, chat_messages, completion_text, system_prompt
from notecodes.functions.tokens import tokenizer_count_udf
from notecodes.operators import checks, clean, evaluate, profile, score, split
from notecodes.session import scratch_path, staged
from notecodes.sources import fixtures, io
from notecodes.streaming.score_stream import run_stream_once

Query = Callable[[SparkSession, str], DataFrame]
OPTS = PrepareOptions()
T = DEFAULT_TEMPLATE
#: Bytes of notes a note file holds, about: each is read back as one value.
NOTE_FILE_BYTES = 4 << 20


# ---- shared lazy stages ---------------------------------------------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_examples(spark, sf)


def stripped(spark, sf):
    return clean.strip_inputs(raw(spark, sf))


def targets(spark, sf):
    return clean.with_targets(stripped(spark, sf))


def classified(spark, sf):
    return clean.classify(raw(spark, sf), OPTS)


def clean_rows(spark, sf):
    return clean.clean_rows(classified(spark, sf), OPTS)


def splits(spark, sf):
    """The split table as the Prepare job makes it: classified once, from a staged table,
    with the narrow kept ids written once for the thresholds and the wide semi join."""
    accepted = staged(clean.accepted_rows(classified(spark, sf)), "accepted")
    return clean.labelled_rows(accepted, staged(clean.first_rows(accepted), "kept"), OPTS)


def predictions(spark, sf):
    return fixtures.fixture_predictions(clean_rows(spark, sf))


def paired(spark, sf):
    s = splits(spark, sf)
    return evaluate.pair_predictions(s, fixtures.fixture_predictions(s))


def per_row_metrics(spark, sf):
    return evaluate.example_metric_rows(paired(spark, sf))


def bar(col) -> F.Column:
    return F.array_join(col, "|")


def r9(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 9) for c in cols})


# ---- step 1: codes ----------------------------------------------------------

def q_extract_codes(spark, sf):
    s = stripped(spark, sf)
    return s.select("row_no", bar(extract_codes(F.col("raw_output"))).alias("output_codes"),
                    bar(extract_codes(F.col("raw_icd_code"))).alias("icd_codes"))


def q_canonical_text(spark, sf):
    return targets(spark, sf).select("row_no", "normalized_output", "normalized_icd_code")


def q_normalize_code(spark, sf):
    s = stripped(spark, sf)
    return s.select("row_no", normalize_code(F.col("raw_output")).alias("output_as_code"),
                    normalize_code(F.col("raw_icd_code")).alias("icd_as_code"))


def q_code_variants(spark, sf):
    codes = targets(spark, sf).select("row_no", F.explode("target_codes").alias("code"))
    return codes.select("row_no", "code", bar(code_variants(F.col("code"))).alias("variants"))


# ---- step 2: clean ----------------------------------------------------------

def q_strip_inputs(spark, sf):
    return stripped(spark, sf)


def q_target_choice(spark, sf):
    return targets(spark, sf).select("row_no", "normalized_output", "normalized_icd_code", "target_text")


def q_label_mismatch(spark, sf):
    return targets(spark, sf).select("row_no", "had_label_mismatch")


def _checkable(spark, sf):
    return targets(spark, sf).where((F.col("ehr_text") != "") & (F.col("target_text") != ""))


def q_leakage_note(spark, sf):
    upper = _checkable(spark, sf).select("row_no", F.upper("ehr_text").alias("upper_note"), "target_codes")
    return upper.select("row_no", leaks_in_upper(F.col("upper_note"), F.col("target_codes")).alias("leak_in_note"))


def q_leakage_prompt(spark, sf):
    """F5 after F4, on the system prompt only (the oracle tests the whole prompt)."""
    t = _checkable(spark, sf).withColumn("upper_note", F.upper("ehr_text"))
    system = system_prompt(F.col("instruction"), OPTS.system_prompt)
    note_leak = leaks_in_upper(F.col("upper_note"), F.col("target_codes"))
    return t.select("row_no", ((~note_leak) & leaks(system, F.col("target_codes"))).alias("leak_in_prompt"))


def q_reject_reasons(spark, sf):
    c = classified(spark, sf)
    return c.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def q_rejects_table(spark, sf):
    return clean.rejects(classified(spark, sf))


# ---- step 3: ids, dedup, stats ---------------------------------------------

def q_example_ids(spark, sf):
    return classified(spark, sf).where(F.col("reject_reason").isNull()).select("row_no", "example_id")


def q_dedup_first_seen(spark, sf):
    return clean_rows(spark, sf).select("example_id", "row_no")


def q_clean_table(spark, sf):
    return clean_rows(spark, sf).select(*clean.CLEAN_COLUMNS, "row_no")


def q_cleaning_stats(spark, sf):
    return clean.cleaning_stats(classified(spark, sf))


# ---- step 4: prompts ---------------------------------------------------------

def q_prompt_text(spark, sf):
    return clean_rows(spark, sf).select("example_id", "prompt_text")


def q_training_text(spark, sf):
    return clean_rows(spark, sf).select("example_id", "text")


def q_chat_messages(spark, sf):
    c = clean_rows(spark, sf)
    msgs = chat_messages(system_prompt(F.col("instruction"), OPTS.system_prompt), F.col("ehr_text"), T)
    m = c.select("example_id", msgs.alias("m"))
    return m.select("example_id", F.col("m")[0]["role"].alias("role_1"), F.col("m")[0]["content"].alias("content_1"),
                    F.col("m")[1]["role"].alias("role_2"), F.col("m")[1]["content"].alias("content_2"))


def _train(spark, sf):
    return splits(spark, sf).where(F.col("split") == "train")


def q_prompt_completion(spark, sf):
    return _train(spark, sf).select("example_id", F.col("prompt_text").alias("prompt"),
                                    completion_text(F.col("target_text"), T).alias("completion"))


def q_completion_span(spark, sf):
    t = _train(spark, sf)
    return t.select("example_id", F.length("prompt_text").cast("bigint").alias("loss_start"),
                    F.length(completion_text(F.col("target_text"), T)).cast("bigint").alias("loss_len"))


# ---- step 5: split -------------------------------------------------------------

def q_split_sizes(spark, sf):
    return split.split_counts(splits(spark, sf))


def q_split_assignment(spark, sf):
    return split.global_rank(splits(spark, sf), OPTS).select("example_id", "split_rank", "split")


def q_split_invariants(spark, sf):
    return split.split_invariants(staged(splits(spark, sf).select("example_id", "ehr_text", "split"), "split_rows"))


def q_first_n_train(spark, sf):
    """L1 with a limit that bites at every scale."""
    train = staged(_train(spark, sf).select("example_id", "split_key"), "train")
    return split.limit_first(train, 100)


def q_first_n_rows(spark, sf):
    """L2: the first rows in source order, as an explicit argument asks for."""
    rows = staged(clean_rows(spark, sf).select("example_id", "row_no"), "clean_ids")
    return profile.first_rows(rows, 100)


# ---- step 6: profile ------------------------------------------------------------

def q_instruction_profile(spark, sf):
    return profile.instruction_profile(raw(spark, sf))


def q_instruction_preview(spark, sf):
    return profile.instruction_preview(raw(spark, sf))


def _sample(spark, sf):
    return profile.first_rows(clean_rows(spark, sf), OPTS.sample_report_size)


def q_code_count_summary(spark, sf):
    return profile.numeric_summary(_sample(spark, sf), "num_codes")


def q_note_length_summary(spark, sf):
    s = _sample(spark, sf).select(F.length("ehr_text").alias("note_len"))
    return profile.numeric_summary(s, "note_len")


def q_token_length_summary(spark, sf):
    return profile.numeric_summary(profile.profile_series(_sample(spark, sf)), "value", by=["metric"])


def _report(spark, sf):
    c = staged(classified(spark, sf), "classified")
    accepted = clean.accepted_rows(c)
    rows = clean.labelled_rows(accepted, staged(clean.first_rows(accepted), "kept"), OPTS)
    return profile.dataset_report(raw(spark, sf), rows, clean.cleaning_stats(c), OPTS.sample_report_size)


REPORT_SERIES = ("prompt_token_length", "full_text_token_length", "num_codes_per_example")


def q_dataset_report(spark, sf):
    """R1 flattened to scalar columns (the timestamp is left out; ``report_json``
    checks the whole document)."""
    return _flat_report(_report(spark, sf))


def _flat_report(r):
    stats = F.array_join(F.array_sort(F.transform(
        F.map_entries("cleaning_stats"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ";")
    cols = [
        "raw_rows", "clean_rows",
        F.col("splits")["train"].alias("n_train"), F.col("splits")["validation"].alias("n_validation"),
        F.col("splits")["test"].alias("n_test"),
        F.array_join("columns", "|").alias("columns"), "unique_instruction_count",
        F.array_join("instruction_preview", "|", "NULL").alias("instruction_preview"),
        stats.alias("cleaning_stats"), "sample_size_for_report",
    ]
    for series in REPORT_SERIES:
        cols += [F.col(series)[f].alias(f"{series}_{f}") for f in profile.SUMMARY_FIELDS]
    return r.select(*cols)


# ---- step 7: evaluate ----------------------------------------------------------

def q_example_metrics(spark, sf):
    return per_row_metrics(spark, sf).select("example_id", *evaluate.METRIC_COLUMNS)


def q_macro_metrics(spark, sf):
    m = per_row_metrics(spark, sf).agg(*[F.avg(c).alias(c) for c in evaluate.METRIC_COLUMNS])
    return r9(m, evaluate.METRIC_COLUMNS)


def q_micro_metrics(spark, sf):
    sums = per_row_metrics(spark, sf).agg(
        F.sum("true_positives").cast("bigint").alias("true_positives"),
        F.sum("num_predicted_codes").cast("bigint").alias("predicted_codes"),
        F.sum("num_reference_codes").cast("bigint").alias("reference_codes"),
    )
    p = F.when(F.col("predicted_codes") > 0, F.col("true_positives") / F.col("predicted_codes")).otherwise(F.lit(0.0))
    r = F.when(F.col("reference_codes") > 0, F.col("true_positives") / F.col("reference_codes")).otherwise(F.lit(0.0))
    out = sums.withColumns({"micro_precision": p, "micro_recall": r})
    out = out.withColumn("micro_f1", F.when(F.col("micro_precision") + F.col("micro_recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("micro_precision") * F.col("micro_recall") / (F.col("micro_precision") + F.col("micro_recall"))))
    return r9(out, ["micro_precision", "micro_recall", "micro_f1"])


def q_evaluation_row(spark, sf):
    return r9(evaluate.evaluation_aggregates(per_row_metrics(spark, sf)), evaluate.EVALUATION_FIELDS)


def q_metrics_by_split(spark, sf):
    return r9(evaluate.evaluation_aggregates(per_row_metrics(spark, sf), by=["split"]), evaluate.EVALUATION_FIELDS)


def q_prediction_rows(spark, sf):
    return evaluate.prediction_records(paired(spark, sf))


def q_prediction_gaps(spark, sf):
    """F12 over predictions with missing, extra and repeated ids."""
    s = staged(splits(spark, sf).select("example_id", "row_no", "target_text", "target_codes", "split"), "split_ids")
    test = s.where(F.col("split") == "test")
    own = fixtures.fixture_predictions(test.where(F.col("row_no") % 11 != 0))
    extra = fixtures.fixture_predictions(s.where((F.col("split") == "validation") & (F.col("row_no") % 3 == 0)))
    again = fixtures.fixture_predictions(test.where((F.col("row_no") % 7 == 1) & (F.col("row_no") % 11 != 0)))
    return evaluate.prediction_gaps(test, own.union(extra).union(again))


# ---- step 8: checks ---------------------------------------------------------------

def q_template_check(spark, sf):
    return checks.template_check(clean_rows(spark, sf), T)


def q_request_check(spark, sf):
    v = checks.request_violations(fixtures.request_rows(spark, sf))
    return v.select("request_id", "valid", bar(F.col("violations")).alias("violations"))


def q_over_budget(spark, sf):
    return r9(checks.over_budget(splits(spark, sf), 1024), ["share_over_budget"])


def q_length_buckets(spark, sf):
    return checks.length_buckets(clean_rows(spark, sf), 128)


# ---- step 9: score -------------------------------------------------------------------

def q_batch_predict(spark, sf):
    scored = score.score_notes(fixtures.notes_table(spark, sf))
    return scored.select("row_no", F.col("normalized_prediction").alias("prediction"))


def q_parse_predictions(spark, sf):
    p = predictions(spark, sf).withColumnRenamed("prediction", "raw_prediction")
    parsed = score.parse_predictions(p)
    return parsed.select("example_id", "raw_prediction", "normalized_prediction", bar(F.col("codes")).alias("codes"))


# ---- step 10: io, stream ------------------------------------------------------------

def q_save_and_reload_split(spark, sf):
    out = scratch_path(spark, "splits")
    io.save_splits(splits(spark, sf).select("example_id", "split_key", "target_text", "row_no", "split"), out)
    return io.read_split(spark, out, "test").select("example_id", "split_key", "target_text", "row_no")


def q_jsonl_notes(spark, sf):
    out = scratch_path(spark, "scored-notes")
    scored = score.score_notes(fixtures.notes_table(spark, sf))
    io.write_jsonl(scored.select("row_no", "note", "prompt_text", "raw_prediction", "normalized_prediction", "codes"), out)
    back = spark.read.schema("row_no bigint, note string, prompt_text string, raw_prediction string, "
                             "normalized_prediction string, codes array<string>").json(out)
    return back.select("row_no", "normalized_prediction")


def q_note_files(spark, sf):
    """Note files read back one row per file. Files of about ``NOTE_FILE_BYTES`` of notes (not one
    per row) hold them, each note behind its number, both without line breaks."""
    out = scratch_path(spark, "note-files")
    notes = fixtures.notes_table(spark, sf).where(F.col("note").isNotNull())
    line = F.concat(F.col("row_no").cast("string"), F.lit("\x1f"), F.base64(F.encode("note", "UTF-8")))
    size = notes.agg(F.sum(F.octet_length("note")).alias("n")).first()["n"] or 0
    notes.select(F.translate(line, "\r\n", "").alias("value"), "row_no").repartition(1 + size // NOTE_FILE_BYTES, "row_no").select("value").write.text(out)
    files = io.read_note_files(spark, out)
    each = files.select(F.explode(F.split("note", "\n")).alias("line")).where("line <> ''")
    parts = F.split("line", "\x1f")
    note = F.decode(F.unbase64(F.element_at(parts, 2)), "UTF-8")
    return each.select(F.element_at(parts, 1).cast("bigint").alias("row_no"), clean.clean_text(note).alias("note"))


def q_load_or_prepare(spark, sf):
    from notecodes.plans.prepare import load_or_prepare

    out = scratch_path(spark, "prepared")
    load_or_prepare(spark, raw(spark, sf), out, OPTS)
    return load_or_prepare(spark, raw(spark, sf), out, OPTS).select("example_id", "split")


def q_report_json(spark, sf):
    """R1 through S8 and S9: the written document, parsed again, without its time."""
    out = scratch_path(spark, "report")
    report = _report(spark, sf)
    io.write_json_document(report, out)
    doc = io.read_json_document(spark, out).select(F.from_json("json", report.schema).alias("r"))
    return _flat_report(doc.select("r.*"))


def q_report_time(spark, sf):
    """The report's time is UTC text and now (within a day, for the oracle's sake)."""
    n = raw(spark, sf).agg(F.count(F.lit(1)).alias("rows"))
    stamp = profile.created_at_utc()
    return n.select("rows", stamp.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$").alias("is_utc_text"),
                    (F.abs(F.unix_timestamp(F.to_timestamp(stamp)) - F.unix_timestamp()) < 86_400).alias("is_now"))


def q_raw_split(spark, sf):
    """A source of two splits, as JSON and as Parquet, read by split name."""
    source = raw(spark, sf).drop("row_no").withColumn("split", F.when(F.col("icd_code").isNull(), F.lit("other")).otherwise(F.lit("train")))
    out = scratch_path(spark, "raw-split")
    io.write_jsonl(source, f"{out}/json")
    source.write.parquet(f"{out}/parquet")
    got = [io.read_raw(spark, f"{out}/{fmt}", fmt, split=OPTS.raw_split).withColumn("fmt", F.lit(fmt)) for fmt in ("json", "parquet")]
    cols = ("fmt", "ehr_text", "instruction", "output", "icd_code")
    return got[0].select(*cols).unionByName(got[1].select(*cols))


def q_batch_inference(spark, sf):
    """Notes from a JSON-lines file, scored into another, in input order."""
    from notecodes.plans.score_job import run_batch_inference

    src = scratch_path(spark, "notes-file")
    io.write_jsonl(fixtures.notes_table(spark, sf).select("note", "instruction"), src)
    scored = run_batch_inference(spark, src, scratch_path(spark, "scored-file"))
    return scored.select(F.sha2(F.col("note"), 256).alias("note_hash"), "normalized_prediction")


def q_nested_json(spark, sf):
    """Arrays, maps, nulls and non-ASCII text written as JSON and read back."""
    out = scratch_path(spark, "nested")
    x = targets(spark, sf).select("row_no", "target_codes", F.create_map(F.lit("note"), F.col("ehr_text"), F.lit("none"), F.lit(None).cast("string")).alias("parts"))
    io.write_jsonl(x, out)
    back = spark.read.schema("row_no bigint, target_codes array<string>, parts map<string,string>").json(out)
    return back.select("row_no", bar(F.col("target_codes")).alias("codes"), F.col("parts")["note"].alias("note"), F.col("parts")["none"].isNull().alias("is_null"))


def q_token_template(spark, sf):
    """F8 on token ids: words stand for ids by their length."""
    ids = F.transform(F.split("ehr_text", " "), lambda w: F.length(w))
    x = stripped(spark, sf).select("row_no", ids.alias("ids"))
    return x.select("row_no", checks.contains_token_run(F.col("ids"), (2, 3)).alias("has_run"))


def q_empty_training(spark, sf):
    """the checks' verdicts as rows (counted from the table)."""
    train = staged(_train(spark, sf).select("example_id", "split_key"), "train")

    def fails(check) -> bool:
        try:
            check()
        except ValueError:
            return True
        return False

    verdicts = [
        ("empty_training", fails(lambda: checks.require_not_empty(split.limit_first(train, 0)))),
        ("training", fails(lambda: checks.require_not_empty(train))),
        ("ratios_over_one", fails(lambda: PrepareOptions(train_ratio=0.95).check())),
        ("ratios", fails(OPTS.check)),
    ]
    n = train.agg(F.count(F.lit(1)).cast("bigint").alias("train_rows"))
    rows = F.array(*(F.struct(F.lit(k).alias("check"), F.lit(v).alias("fails")) for k, v in verdicts))
    return n.select("train_rows", F.explode(rows).alias("v")).select("train_rows", "v.check", "v.fails")


def q_tokenizer_counts(spark, sf):
    """U1's plug point with a white-space tokenizer."""
    count = tokenizer_count_udf(lambda: lambda texts: [t.split() for t in texts])
    return stripped(spark, sf).select("row_no", count(F.col("ehr_text")).cast("bigint").alias("n_tokens"))


def q_length_order(spark, sf):
    """L5's order: rows, and neighbours inside a partition that are out of order (none)."""
    rows = checks.group_by_length(staged(clean_rows(spark, sf).select("example_id", "text"), "texts"))
    seen = rows.select("n_tokens", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    w = Window.partitionBy("part").orderBy("at")
    return seen.select("n_tokens", F.lag("n_tokens").over(w).alias("before")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") > F.col("n_tokens")).alias("out_of_order"))


def q_length_batches(spark, sf):
    """L5's batches of the training rows."""
    return checks.length_batches(_train(spark, sf))


def q_cut_prompts(spark, sf):
    """Prompts over the token limit are cut before prediction and flagged; the predictor answers with what it was given."""
    from hashlib import sha256

    seen = lambda options: lambda prompts: [sha256(p.encode()).hexdigest() for p in prompts]
    rows = score.note_prompts(fixtures.notes_table(spark, sf)).select("row_no", "prompt_text")
    cut = score.batch_predict(rows, seen, PredictOptions(max_seq_length=256))
    return cut.select("row_no", F.col("prediction").alias("seen_hash"), "was_cut")


def q_stream_settings(spark, sf):
    """T1 with each request's own settings: an echoing predictor answers with what it was given."""
    src = scratch_path(spark, "requests-in")
    io.write_jsonl(fixtures.request_rows(spark, sf).withColumnRenamed("request_id", "row_no"), src)
    sink = run_stream_once(spark, src, scratch_path(spark, "requests-out"), scratch_path(spark, "requests-ckpt"), factory=score.echo_settings)
    return sink.select("row_no", "raw_prediction")


def q_stream_score(spark, sf):
    src = scratch_path(spark, "notes-in")
    io.write_jsonl(fixtures.notes_table(spark, sf), src)
    sink = run_stream_once(spark, src, scratch_path(spark, "notes-out"), scratch_path(spark, "notes-ckpt"))
    return sink.select("row_no", "normalized_prediction")


def q_evaluation_file(spark, sf):
    """S10 through the Evaluate job: prepare, evaluate the test split with given
    predictions, write rows + ``.metrics.json``, read the metrics back."""
    from notecodes.config import EvaluateOptions
    from notecodes.plans.evaluate_job import read_metrics, run_evaluation
    from notecodes.plans.prepare import prepare

    prepared = scratch_path(spark, "prepared")
    done = prepare(spark, raw(spark, sf), prepared, OPTS)
    known = done.splits.withColumn("target_codes", extract_codes(F.col("target_text")))
    given = fixtures.fixture_predictions(known)  # of all splits: the job takes its own
    out = scratch_path(spark, "eval") + "/test_predictions.jsonl"
    run_evaluation(spark, prepared, out, EvaluateOptions(split="test"), predictions=given)
    m = read_metrics(spark, out)
    return r9(m, evaluate.EVALUATION_FIELDS).select("split", "num_examples", *evaluate.EVALUATION_FIELDS)


def queries() -> dict[str, Query]:
    names = [
        "extract_codes", "canonical_text", "normalize_code", "code_variants",
        "strip_inputs", "target_choice", "label_mismatch", "leakage_note", "leakage_prompt", "reject_reasons",
        "rejects_table",
        "example_ids", "dedup_first_seen", "clean_table", "cleaning_stats",
        "prompt_text", "training_text", "chat_messages", "prompt_completion", "completion_span",
        "split_sizes", "split_assignment", "split_invariants", "first_n_train",
        "instruction_profile", "instruction_preview", "code_count_summary", "note_length_summary",
        "token_length_summary", "dataset_report",
        "example_metrics", "macro_metrics", "micro_metrics", "evaluation_row", "metrics_by_split",
        "prediction_rows", "prediction_gaps",
        "template_check", "request_check", "over_budget", "length_buckets",
        "batch_predict", "parse_predictions", "raw_split", "batch_inference", "nested_json", "token_template",
        "empty_training", "tokenizer_counts", "length_order", "length_batches", "cut_prompts", "stream_settings", "report_time", "first_n_rows",
        "save_and_reload_split", "jsonl_notes", "note_files", "load_or_prepare", "report_json", "stream_score",
        "evaluation_file",
    ]
    g = globals()
    return {n: g[f"q_{n}"] for n in names}
