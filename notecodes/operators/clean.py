"""Cleaning: strip, choose the target, reject with a reason, content id, dedup, stats.

Everything is column expressions, one aggregate and one semi join (the dedup);
rows are never handled one at a time in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notecodes.config import PrepareOptions
from notecodes.functions.codes import canonical_text, codes_to_text, extract_codes, leaks, leaks_in_upper
from notecodes.functions.prompts import prompt_text, system_prompt, training_text
from notecodes.functions.text import clean_text

# Reject reasons, in the order the checks run; the other cleaning
# statistics; the separator between note and target in the content id.
EMPTY_EHR_TEXT = "empty_ehr_text"
EMPTY_TARGET_TEXT = "empty_target_text"
LEAK_IN_NOTE = "label_leakage_in_ehr_text"
LEAK_IN_PROMPT = "label_leakage_in_prompt"
INVALID_TRAINING_TEXT = "invalid_training_text"
REJECT_REASONS = (EMPTY_EHR_TEXT, EMPTY_TARGET_TEXT, LEAK_IN_NOTE, LEAK_IN_PROMPT, INVALID_TRAINING_TEXT)
ROWS_SEEN, DUPLICATE_ROWS, ROWS_KEPT, LABEL_MISMATCHES = "rows_seen", "duplicate_rows", "rows_kept", "label_mismatches"
ID_SEPARATOR = "|||"

# Declared clean schema (the ten reference columns, in order); ``row_no`` is ours.
CLEAN_COLUMNS = (
    "example_id", "ehr_text", "instruction", "raw_icd_code", "raw_output",
    "target_text", "prompt_text", "text", "num_codes", "had_label_mismatch",
)

RAW_COLUMNS = ("ehr_text", "instruction", "output", "icd_code")


def example_id(note: Column, target: Column) -> Column:
    """SHA-256 hex of ``note || '|||' || target`` (both already stripped)."""
    return F.sha2(F.concat(note, F.lit(ID_SEPARATOR), target), 256)


def strip_inputs(raw: DataFrame) -> DataFrame:
    """Null to empty and strip, on the four input columns; keeps ``row_no``."""
    return raw.select(
        "row_no",
        clean_text(F.col("ehr_text")).alias("ehr_text"),
        clean_text(F.col("instruction")).alias("instruction"),
        clean_text(F.col("output")).alias("raw_output"),
        clean_text(F.col("icd_code")).alias("raw_icd_code"),
    )


def with_targets(stripped: DataFrame) -> DataFrame:
    """Canonical label strings, the chosen target and the mismatch flag."""
    out_codes = extract_codes(F.col("raw_output"))
    icd_codes = extract_codes(F.col("raw_icd_code"))
    df = stripped.withColumns({"_out_codes": out_codes, "_icd_codes": icd_codes})
    no = codes_to_text(F.col("_out_codes"))
    nk = codes_to_text(F.col("_icd_codes"))
    df = df.withColumns({"normalized_output": no, "normalized_icd_code": nk})
    use_output = F.col("normalized_output") != ""
    return df.withColumns(
        {
            "target_text": F.when(use_output, F.col("normalized_output")).otherwise(F.col("normalized_icd_code")),
            "target_codes": F.when(use_output, F.col("_out_codes")).otherwise(F.col("_icd_codes")),
            "had_label_mismatch": (F.col("normalized_output") != "")
            & (F.col("normalized_icd_code") != "")
            & (F.col("normalized_output") != F.col("normalized_icd_code")),
        }
    ).drop("_out_codes", "_icd_codes")


NOTE_UPPER = "_note_upper"


def reject_reason(opts: PrepareOptions = PrepareOptions()) -> Column:
    """the first failing check names the reason; NULL means accepted.

    ``CASE`` stops at the first true branch, so the leakage scans only run on
    rows with a note and a target. Needs the ``_note_upper`` column (the note
    upper-cased once, see ``classify``).
    """
    note, target, codes = F.col("ehr_text"), F.col("target_text"), F.col("target_codes")
    system = system_prompt(F.col("instruction"), opts.system_prompt)
    if opts.template.isolates_fields():
        # The note was tested one branch earlier; only the system prompt is left.
        prompt_leak = leaks(system, codes)
    else:
        prompt_leak = leaks(prompt_text(system, note, opts.template), codes)
    return (
        F.when(note == "", F.lit(EMPTY_EHR_TEXT))
        .when(target == "", F.lit(EMPTY_TARGET_TEXT))
        .when(leaks_in_upper(F.col(NOTE_UPPER), codes), F.lit(LEAK_IN_NOTE))
        .when(prompt_leak, F.lit(LEAK_IN_PROMPT))
        .when(canonical_text(target) == "", F.lit(INVALID_TRAINING_TEXT))
    )


def fence(df: DataFrame) -> DataFrame:
    """Keep later filters above the columns computed so far.

    Catalyst pushes a filter on a computed column below its projection by
    inlining the expression, so the regex and leakage work would run twice (in
    the filter, then in the projection). A one-row ``inline`` is a Generate node,
    which filters on its output cannot cross; it costs one struct per row.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def classify(raw: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """Every raw row with ``reject_reason`` and, when accepted, ``example_id``."""
    # The note is upper-cased once, in its own projection: the leakage check reads
    # it several times and Catalyst keeps a non-cheap column that is read more
    # than once out of the consumer. It is dropped before the fence.
    reaches_leak_check = (F.col("ehr_text") != "") & (F.col("target_text") != "")
    df = with_targets(strip_inputs(raw)).withColumn(
        NOTE_UPPER, F.when(reaches_leak_check, F.upper(F.col("ehr_text"))).otherwise(F.lit("")))
    df = df.withColumn("reject_reason", reject_reason(opts)).drop(NOTE_UPPER)
    df = df.withColumn(
        "example_id",
        F.when(F.col("reject_reason").isNull(), example_id(F.col("ehr_text"), F.col("target_text"))),
    )
    return fence(df)


def first_rows(accepted: DataFrame) -> DataFrame:
    """``example_id, row_no`` of the earliest row per id (narrow, one row per id).

    A hash aggregate with a map-side partial step: a hot duplicate is reduced
    to one row per map task before anything moves.
    """
    return accepted.groupBy("example_id").agg(F.min("row_no").alias("row_no"))


def first_seen(accepted: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """W1 + J2: keep the earliest ``row_no`` per ``example_id``.

    The ids are deduplicated on the narrow ``(example_id, row_no)`` columns
    (``first_rows``); the wide rows are then kept by a semi join on that unique
    pair: they are shuffled once and never sorted (shuffle-hash join with
    the narrow side as build). Read ``accepted`` from a staged table: it
    is scanned twice (narrow, then wide).
    """
    kept = first_rows(accepted) if kept is None else kept
    # Keyed on (example_id, row_no), so a source repeating a row number cannot
    # let a second row through; the pair is unique and spreads evenly.
    return accepted.join(kept.hint("shuffle_hash"), ["example_id", "row_no"], "left_semi")


def first_seen_window(accepted: DataFrame) -> DataFrame:
    """W1 as a window (same rows as ``first_seen``): ``row_number() = 1`` with a
    partial WindowGroupLimit before the shuffle. Sorts the wide rows."""
    w = Window.partitionBy("example_id").orderBy("row_no")
    return accepted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def finish_clean(deduped: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """P3-P6, P9, P11 after dedup: the wide prompt columns are built last."""
    system = system_prompt(F.col("instruction"), opts.system_prompt)
    prompt = prompt_text(system, F.col("ehr_text"), opts.template)
    return deduped.withColumn("prompt_text", prompt).select(
        "example_id", "ehr_text", "instruction", "raw_icd_code", "raw_output", "target_text", "prompt_text",
        training_text(F.col("prompt_text"), F.col("target_text"), opts.template).alias("text"),
        F.size("target_codes").cast("int").alias("num_codes"),
        "had_label_mismatch", "row_no", "target_codes",
        *[c for c in ("split_key", "split") if c in deduped.columns],
    )


_CARRY = ("row_no", "example_id", "ehr_text", "instruction", "raw_icd_code", "raw_output",
          "target_text", "target_codes", "had_label_mismatch")


def accepted_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNull()).select(*_CARRY)


def clean_rows(classified: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """Accepted, deduplicated rows in the clean layout (+ ``row_no``, ``target_codes``)."""
    return finish_clean(first_seen(accepted_rows(classified)), opts)


def clean_split_rows(classified: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """Deduplicated rows with ``split_key`` and ``split``, prompt columns built last.

    One shuffle of wide rows (the dedup); the split thresholds come from the
    narrow accepted ids through a scalar subquery.
    """
    accepted = accepted_rows(classified)
    return labelled_rows(accepted, first_rows(accepted), opts)


def labelled_rows(accepted: DataFrame, kept: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """The kept rows of ``accepted`` with their split; ``kept`` (``example_id, row_no``) is
    best read from a written table, as the thresholds and the join both use it."""
    from notecodes.operators.split import assign_splits

    labelled = assign_splits(first_seen(accepted, kept), opts, ids=kept.select("example_id"))
    return finish_clean(labelled, opts)


def clean_table(raw: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """The declared ten-column clean table plus ``row_no``."""
    return clean_rows(classify(raw, opts), opts).select(*CLEAN_COLUMNS, "row_no")


def rejects(classified: DataFrame) -> DataFrame:
    """F7 as a table: rejected rows with their reason (the reference only counts them)."""
    return classified.where(F.col("reject_reason").isNotNull()).select("row_no", "reject_reason")


def cleaning_stats(classified: DataFrame) -> DataFrame:
    """A1 as a long table ``(stat, n)``; a stat that never occurred is absent.

    Two small aggregations, no dedup of wide rows: ``(reject_reason, example_id)``
    groups are partially aggregated map-side, so a hot duplicate costs one row
    per map task. ``duplicate_rows`` = accepted - kept; ``label_mismatches`` is
    read from each id's first row.
    """
    per_id = classified.groupBy("reject_reason", "example_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by(F.col("had_label_mismatch").cast("int"), F.col("row_no")).alias("first_mismatch"),
    )
    per_reason = per_id.groupBy("reject_reason").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("ids"),
        F.sum("first_mismatch").alias("mismatches"),
    )
    accepted = F.col("reject_reason").isNull()

    def item(stat: Column, n: Column) -> Column:
        return F.struct(stat.alias("stat"), n.cast("bigint").alias("n"))

    items = F.array(
        item(F.lit(ROWS_SEEN), F.col("rows")),
        item(F.col("reject_reason"), F.col("rows")),
        item(F.when(accepted, F.lit(DUPLICATE_ROWS)), F.col("rows") - F.col("ids")),
        item(F.when(accepted, F.lit(ROWS_KEPT)), F.col("ids")),
        item(F.when(accepted, F.lit(LABEL_MISMATCHES)), F.col("mismatches")),
    )
    return (
        per_reason.select(F.explode(items).alias("s"))
        .select("s.stat", "s.n")
        .where(F.col("stat").isNotNull())
        .groupBy("stat")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .where(F.col("n") > 0)
    )
