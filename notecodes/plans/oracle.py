"""DuckDB SQL for every checked query: an independent rendering of the same rules.

The SQL follows the reference's definitions directly (e.g. leakage on the whole
prompt, a plain ``row_number()`` over the whole table for split ranks), so it
also checks the shortcuts the Spark plans take. Tables are the driver's views.
"""

from __future__ import annotations

from notecodes.config import BatchOptions, PrepareOptions
from notecodes.functions.prompts import DEFAULT_SYSTEM_PROMPT, DEFAULT_TEMPLATE

# Fixed values, stated here anew so that an error in the package cannot pass on both sides.
# RE2's \b is ASCII (the tables have no letters beside codes that it would misjudge).
PAT = r"\b[A-TV-Z][0-9][0-9A-Z](?:\.?[0-9A-Z]{0,4})\b"
PY_SPACE_CLASS = (
    r"[\x09-\x0D\x1C-\x20\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
APPROX_TOKEN_PATTERN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_ \t\n\x0B\f\r]"
REQUEST_RANGES = {"max_new_tokens": (1, 128), "temperature": (0.0, 2.0), "top_p": (0.0, 1.0), "num_beams": (1, 8)}
OPTS = PrepareOptions()
T = DEFAULT_TEMPLATE


def lit(s: str) -> str:
    """A DuckDB string expression for ``s`` (newlines through ``chr(10)``)."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted)


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$', '', 'g')"


def norm_match(m: str) -> str:
    d = f"replace({m}, '.', '')"
    return f"CASE WHEN length({d}) > 3 THEN substr({d}, 1, 3) || '.' || substr({d}, 4) ELSE {d} END"


def extract(t: str) -> str:
    lst = f"list_transform(regexp_extract_all(upper(coalesce({t}, '')), '{PAT}'), lambda m_: {norm_match('m_')})"
    return f"list_filter({lst}, lambda x_, i_: list_position({lst}, x_) = i_)"


def canon(t: str) -> str:
    return f"array_to_string({extract(t)}, ', ')"


def norm_any(x: str) -> str:
    """Full single-code normalization for any input string."""
    cleaned = f"regexp_replace(upper({x}), '[^A-Za-z0-9.]', '', 'g')"
    single = f"replace({cleaned}, '..', '.')"
    dotless = f"replace({single}, '.', '')"
    ndots = f"(length({single}) - length({dotless}))"

    def after3(s: str) -> str:
        return f"CASE WHEN length({s}) > 3 THEN substr({s}, 1, 3) || '.' || substr({s}, 4) ELSE {s} END"

    shaped = (
        f"CASE WHEN {ndots} > 1 THEN {after3(dotless)} "
        f"WHEN {ndots} = 0 THEN {after3(single)} "
        f"ELSE substr(split_part({single}, '.', 1), 1, 3) || '.' || substr({single}, strpos({single}, '.') + 1) END"
    )
    return f"CASE WHEN {cleaned} = '' THEN '' ELSE rtrim({shaped}, '.') END"


def leaks(text: str, codes: str) -> str:
    return (
        f"(coalesce({text}, '') <> '' AND len(list_filter({codes}, lambda c_: "
        f"contains(upper({text}), c_) OR contains(upper({text}), replace(c_, '.', '')))) > 0)"
    )


def prompt(system: str, note: str) -> str:
    return (
        f"{lit(T.bos + T.header(T.system_role))} || {system} || {lit(T.eot + T.header(T.user_role))} || "
        f"{note} || {lit(T.eot + T.header(T.assistant_role))}"
    )


def tokens(t: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({t}, ''), '{APPROX_TOKEN_PATTERN}')) AS INTEGER)"


BATCHES = BatchOptions()
MEGA = BATCHES.batch_size * BATCHES.mega_batches
HOLD = OPTS.val_ratio + OPTS.test_ratio
TEST_SHARE = OPTS.test_ratio / HOLD

# The chain every query starts from: fixture -> strip -> targets -> reasons ->
# ids -> first-seen -> clean -> split.
BASE = f"""
fx AS (
  SELECT doc_id, text, n_chars,
    concat(chr(CAST(65 + n_chars % 20 AS INT)), lpad(CAST(n_chars % 100 AS VARCHAR), 2, '0'), '.', CAST(n_chars % 10 AS VARCHAR)) AS c1,
    concat(chr(CAST(65 + n_chars % 19 AS INT)), lpad(CAST((n_chars * 3) % 100 AS VARCHAR), 2, '0'), CAST(n_chars % 7 AS VARCHAR)) AS c2
  FROM documents),
raw AS (
  SELECT doc_id AS row_no,
    CASE WHEN doc_id % 37 = 5 THEN '   '
         WHEN doc_id % 41 = 6 THEN CAST(NULL AS VARCHAR)
         WHEN doc_id % 23 = 7 THEN concat(text, ' Coded ', replace(c1, '.', ''), ' today')
         ELSE concat('  ', text, ' ') END AS ehr_text,
    CASE WHEN doc_id % 13 = 3 THEN concat('Sample answer: ', lower(c1))
         WHEN doc_id % 5 = 0 THEN CAST(NULL AS VARCHAR)
         WHEN doc_id % 5 = 1 THEN '  '
         WHEN doc_id % 5 = 2 THEN 'List the codes.'
         ELSE ' Assign codes. ' END AS instruction,
    CASE WHEN doc_id % 17 = 4 THEN CAST(NULL AS VARCHAR)
         WHEN n_chars % 3 = 0 THEN concat(lower(c1), ' and ', c2, ', ', c1)
         WHEN doc_id % 29 = 8 THEN 'none'
         ELSE concat('Codes: ', c1, '.') END AS output,
    CASE WHEN doc_id % 17 = 4 AND doc_id % 2 = 0 THEN 'n/a'
         WHEN doc_id % 7 = 2 THEN c2
         WHEN doc_id % 29 = 8 THEN ''
         WHEN n_chars % 3 = 0 THEN concat(c1, '; ', c2)
         ELSE replace(c1, '.', '') END AS icd_code
  FROM fx),
s AS (
  SELECT row_no, {strip('ehr_text')} AS ehr_text, {strip('instruction')} AS instruction,
         {strip('output')} AS raw_output, {strip('icd_code')} AS raw_icd_code
  FROM raw),
x AS (SELECT *, {extract('raw_output')} AS out_codes, {extract('raw_icd_code')} AS icd_codes FROM s),
t AS (SELECT *, array_to_string(out_codes, ', ') AS normalized_output,
             array_to_string(icd_codes, ', ') AS normalized_icd_code FROM x),
u AS (
  SELECT *,
    CASE WHEN normalized_output <> '' THEN normalized_output ELSE normalized_icd_code END AS target_text,
    CASE WHEN normalized_output <> '' THEN out_codes ELSE icd_codes END AS target_codes,
    (normalized_output <> '' AND normalized_icd_code <> '' AND normalized_output <> normalized_icd_code) AS had_label_mismatch,
    CASE WHEN instruction <> '' THEN instruction ELSE {lit(DEFAULT_SYSTEM_PROMPT)} END AS system_prompt
  FROM t),
up AS (SELECT *, {prompt('system_prompt', 'ehr_text')} AS full_prompt FROM u),
cl AS (
  SELECT *,
    CASE WHEN ehr_text = '' THEN 'empty_ehr_text'
         WHEN target_text = '' THEN 'empty_target_text'
         WHEN {leaks('ehr_text', 'target_codes')} THEN 'label_leakage_in_ehr_text'
         WHEN {leaks('full_prompt', 'target_codes')} THEN 'label_leakage_in_prompt'
         WHEN {canon('target_text')} = '' THEN 'invalid_training_text' END AS reject_reason
  FROM up),
cid AS (SELECT *, CASE WHEN reject_reason IS NULL THEN sha256(ehr_text || '|||' || target_text) END AS example_id FROM cl),
kept AS (
  SELECT * FROM cid WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY row_no) = 1),
clean AS (
  SELECT example_id, ehr_text, instruction, raw_icd_code, raw_output, target_text,
    full_prompt AS prompt_text,
    CASE WHEN {canon('target_text')} <> '' THEN full_prompt || {canon('target_text')} || {lit(T.eot)} END AS text,
    CAST(len(target_codes) AS INTEGER) AS num_codes, had_label_mismatch, row_no, target_codes
  FROM kept),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY sha256('{OPTS.seed}:' || example_id)) AS split_rank,
         count(*) OVER () AS n_rows
  FROM clean),
sized AS (SELECT *, CAST(ceil(round(CAST({HOLD!r} AS DOUBLE) * n_rows, 6)) AS BIGINT) AS n_hold FROM ranked),
sized2 AS (SELECT *, CAST(ceil(round(CAST({TEST_SHARE!r} AS DOUBLE) * n_hold, 6)) AS BIGINT) AS n_test FROM sized),
splits AS (
  SELECT * EXCLUDE (n_rows, n_hold, n_test), sha256('{OPTS.seed}:' || example_id) AS split_key,
    CASE WHEN split_rank <= n_rows - n_hold THEN 'train'
         WHEN split_rank <= n_rows - n_test THEN 'validation' ELSE 'test' END AS split
  FROM sized2),
preds AS (
  SELECT example_id,
    CASE row_no % 5
      WHEN 0 THEN target_text
      WHEN 1 THEN 'Codes: ' || target_codes[1] || ', Z99.9'
      WHEN 2 THEN 'none'
      WHEN 3 THEN lower(replace(target_text, '.', ''))
      ELSE target_codes[len(target_codes)] || ' ' || target_codes[len(target_codes)] END AS prediction
  FROM clean),
per_row AS (
  SELECT s.example_id, s.split, s.prompt_text, s.target_text, p.prediction,
         {extract('p.prediction')} AS pc, s.target_codes AS rc
  FROM splits s JOIN preds p USING (example_id)),
m AS (
  SELECT *, CAST(len(pc) AS DOUBLE) AS np, CAST(len(rc) AS DOUBLE) AS nr,
         CAST(len(list_intersect(pc, rc)) AS DOUBLE) AS tp
  FROM per_row),
m2 AS (
  SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS precision,
            CASE WHEN nr > 0 THEN tp / nr ELSE 0.0 END AS recall,
            CASE WHEN tp = np AND tp = nr THEN 1.0 ELSE 0.0 END AS exact_match
  FROM m),
m3 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1
  FROM m2)
"""


def q(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


def summary_sql(source: str, value: str, by: str | None = None) -> str:
    """count/min/max/mean + nearest-rank half-even percentiles over ``value``."""
    k = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    pcts = ",\n".join(
        f"CAST(min(v) FILTER (WHERE cum > least(n - 1, round_even(CAST({p / 100!r} AS DOUBLE) * (n - 1), 0))) AS DOUBLE) AS p{p}"
        for p in (50, 90, 95, 99)
    )
    return f"""
, src AS ({source}),
h AS (SELECT {k}{value} AS v, count(*) AS c FROM src GROUP BY ALL),
hc AS (SELECT {k}v, c, sum(c) OVER ({part}ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              sum(c) OVER ({part}) AS n FROM h)
SELECT {k}CAST(any_value(n) AS DOUBLE) AS count, CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max,
       sum(CAST(v AS DOUBLE) * c) / any_value(n) AS mean,
{pcts}
FROM hc {group}"""


def _report_sql() -> str:
    series = ("prompt_token_length", "full_text_token_length", "num_codes_per_example")
    fields = ("count", "min", "max", "mean", "p50", "p90", "p95", "p99")
    summary = summary_sql(f"""
SELECT 'prompt_token_length' AS metric, {tokens('prompt_text')} AS value FROM sample_
UNION ALL SELECT 'full_text_token_length', {tokens('text')} FROM sample_
UNION ALL SELECT 'num_codes_per_example', num_codes FROM sample_""", "value", by="metric")
    head, select = summary.rsplit("\nSELECT ", 1)
    flat = ",\n".join(
        f"(SELECT {f} FROM summ WHERE metric = '{s}') AS {s}_{f}" for s in series for f in fields
    )
    return q(f"""
, sample_ AS (SELECT * FROM clean){head.replace(", src AS (", ", src AS (", 1)},
summ AS (SELECT {select}),
inst AS (SELECT instruction, min(row_no) AS first_row, count(*) AS n FROM raw GROUP BY instruction),
per AS (SELECT reject_reason, count(*) AS n, count(DISTINCT example_id) AS ids FROM cid GROUP BY 1),
mis AS (SELECT count(*) FILTER (WHERE had_label_mismatch) AS n FROM kept),
items AS (
  SELECT 'rows_seen' AS stat, sum(n) AS n FROM per
  UNION ALL SELECT reject_reason, n FROM per WHERE reject_reason IS NOT NULL
  UNION ALL SELECT 'duplicate_rows', n - ids FROM per WHERE reject_reason IS NULL
  UNION ALL SELECT 'rows_kept', ids FROM per WHERE reject_reason IS NULL
  UNION ALL SELECT 'label_mismatches', n FROM mis)
SELECT
  (SELECT CAST(sum(n) AS BIGINT) FROM inst) AS raw_rows,
  (SELECT count(*) FROM splits) AS clean_rows,
  (SELECT count(*) FROM splits WHERE split = 'train') AS n_train,
  (SELECT count(*) FROM splits WHERE split = 'validation') AS n_validation,
  (SELECT count(*) FROM splits WHERE split = 'test') AS n_test,
  'ehr_text|instruction|output|icd_code' AS columns,
  (SELECT count(*) FROM inst) AS unique_instruction_count,
  (SELECT string_agg(coalesce(instruction, 'NULL'), '|' ORDER BY first_row)
     FROM (SELECT * FROM inst ORDER BY first_row LIMIT 3)) AS instruction_preview,
  (SELECT string_agg(stat || '=' || CAST(n AS BIGINT), ';' ORDER BY stat) FROM items WHERE n > 0) AS cleaning_stats,
  (SELECT count(*) FROM sample_) AS sample_size_for_report,
{flat}""")


def _evaluation_select(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
, agg AS (
  SELECT {keys}avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, avg(exact_match) AS exact_match,
         avg(np) AS num_predicted_codes, avg(nr) AS num_reference_codes,
         sum(tp) AS stp, sum(np) AS snp, sum(nr) AS snr, count(*) AS num_examples
  FROM m3 {group}),
mic AS (
  SELECT *, CASE WHEN snp > 0 THEN stp / snp ELSE 0.0 END AS micro_precision,
            CASE WHEN snr > 0 THEN stp / snr ELSE 0.0 END AS micro_recall FROM agg)
SELECT {keys}round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       round(exact_match, 9) AS exact_match, round(num_predicted_codes, 9) AS num_predicted_codes,
       round(num_reference_codes, 9) AS num_reference_codes,
       round(micro_precision, 9) AS micro_precision, round(micro_recall, 9) AS micro_recall,
       round(CASE WHEN micro_precision + micro_recall = 0 THEN 0.0
                  ELSE 2.0 * micro_precision * micro_recall / (micro_precision + micro_recall) END, 9) AS micro_f1,
       CAST(num_examples AS BIGINT) AS num_examples
FROM mic"""


def _violations() -> str:
    rules = ["CASE WHEN note IS NULL THEN 'note' END"]
    for name, (lo, hi) in REQUEST_RANGES.items():
        rules.append(f"CASE WHEN {name} IS NULL OR {name} < {lo} OR {name} > {hi} THEN '{name}' END")
    return "list_filter([" + ", ".join(rules) + "], lambda v_: v_ IS NOT NULL)"


REQUESTS = """
SELECT doc_id AS request_id,
  CASE WHEN doc_id % 31 = 3 THEN CAST(NULL AS VARCHAR) ELSE text END AS note,
  CAST(n_chars % 160 AS INTEGER) AS max_new_tokens,
  CAST(doc_id % 25 AS DOUBLE) / 10.0 AS temperature,
  CAST(doc_id % 13 AS DOUBLE) / 10.0 AS top_p,
  CAST(doc_id % 10 AS INTEGER) AS num_beams
FROM documents"""

# Scored notes with the rule predictor: codes written in the (stripped) note.
SCORED = f", scored AS (SELECT row_no, {canon(strip('ehr_text'))} AS normalized_prediction FROM raw)"


def oracle_sql() -> dict[str, str]:
    sql = {
        # step 1: codes
        "extract_codes": q(f"SELECT row_no, array_to_string(out_codes, '|') AS output_codes, array_to_string(icd_codes, '|') AS icd_codes FROM x"),
        "canonical_text": q("SELECT row_no, normalized_output, normalized_icd_code FROM t"),
        "normalize_code": q(f"SELECT row_no, {norm_any('raw_output')} AS output_as_code, {norm_any('raw_icd_code')} AS icd_as_code FROM s"),
        "code_variants": q(f"""
, codes AS (SELECT row_no, unnest(target_codes) AS code FROM u)
SELECT row_no, code,
  CASE WHEN {norm_any('code')} = '' THEN ''
       WHEN {norm_any('code')} = replace({norm_any('code')}, '.', '') THEN {norm_any('code')}
       ELSE {norm_any('code')} || '|' || replace({norm_any('code')}, '.', '') END AS variants
FROM codes"""),
        # step 2: clean
        "strip_inputs": q("SELECT row_no, ehr_text, instruction, raw_output, raw_icd_code FROM s"),
        "target_choice": q("SELECT row_no, normalized_output, normalized_icd_code, target_text FROM u"),
        "label_mismatch": q("SELECT row_no, had_label_mismatch FROM u"),
        "leakage_note": q(f"SELECT row_no, {leaks('ehr_text', 'target_codes')} AS leak_in_note FROM u WHERE ehr_text <> '' AND target_text <> ''"),
        "leakage_prompt": q(f"""
SELECT row_no, (NOT {leaks('ehr_text', 'target_codes')}) AND {leaks('full_prompt', 'target_codes')} AS leak_in_prompt
FROM up WHERE ehr_text <> '' AND target_text <> ''"""),
        "reject_reasons": q("SELECT coalesce(reject_reason, 'accepted') AS reason, count(*) AS n FROM cl GROUP BY 1"),
        "rejects_table": q("SELECT row_no, reject_reason FROM cl WHERE reject_reason IS NOT NULL"),
        # step 3: ids, dedup, stats
        "example_ids": q("SELECT row_no, example_id FROM cid WHERE reject_reason IS NULL"),
        "dedup_first_seen": q("SELECT example_id, row_no FROM kept"),
        "clean_table": q("""
SELECT example_id, ehr_text, instruction, raw_icd_code, raw_output, target_text, prompt_text, text,
       num_codes, had_label_mismatch, row_no FROM clean"""),
        "cleaning_stats": q("""
, per AS (SELECT reject_reason, count(*) AS n, count(DISTINCT example_id) AS ids FROM cid GROUP BY 1),
mis AS (SELECT count(*) FILTER (WHERE had_label_mismatch) AS n FROM kept),
items AS (
  SELECT 'rows_seen' AS stat, sum(n) AS n FROM per
  UNION ALL SELECT reject_reason, n FROM per WHERE reject_reason IS NOT NULL
  UNION ALL SELECT 'duplicate_rows', n - ids FROM per WHERE reject_reason IS NULL
  UNION ALL SELECT 'rows_kept', ids FROM per WHERE reject_reason IS NULL
  UNION ALL SELECT 'label_mismatches', n FROM mis)
SELECT stat, CAST(n AS BIGINT) AS n FROM items WHERE n > 0"""),
        # step 4: prompts
        "prompt_text": q("SELECT example_id, prompt_text FROM clean"),
        "training_text": q("SELECT example_id, text FROM clean"),
        "chat_messages": q(f"""
SELECT example_id, {lit(T.system_role)} AS role_1,
       CASE WHEN instruction <> '' THEN instruction ELSE {lit(DEFAULT_SYSTEM_PROMPT)} END AS content_1,
       {lit(T.user_role)} AS role_2, ehr_text AS content_2 FROM clean"""),
        "prompt_completion": q(f"SELECT example_id, prompt_text AS prompt, target_text || {lit(T.eot)} AS completion FROM splits WHERE split = 'train'"),
        "completion_span": q(f"""
SELECT example_id, CAST(length(prompt_text) AS BIGINT) AS loss_start,
       CAST(length(target_text || {lit(T.eot)}) AS BIGINT) AS loss_len FROM splits WHERE split = 'train'"""),
        # step 5: split
        "split_sizes": q("SELECT split, count(*) AS n FROM splits GROUP BY 1"),
        "split_assignment": q("SELECT example_id, split_rank, split FROM splits"),
        "split_invariants": q("""
, per_id AS (SELECT example_id, count(DISTINCT split) AS k FROM splits GROUP BY 1),
per_note AS (SELECT sha256(ehr_text) AS h, count(DISTINCT split) AS k FROM splits GROUP BY 1)
SELECT 'total_rows' AS "check", CAST(count(*) AS BIGINT) AS n FROM splits
UNION ALL SELECT 'rows_in_splits', CAST(count(*) FILTER (WHERE split IN ('train', 'validation', 'test')) AS BIGINT) FROM splits
UNION ALL SELECT 'distinct_ids', CAST(count(*) AS BIGINT) FROM per_id
UNION ALL SELECT 'ids_in_two_splits', CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) FROM per_id
UNION ALL SELECT 'notes_in_two_splits', CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) FROM per_note"""),
        "first_n_train": q("SELECT example_id, split_key FROM splits WHERE split = 'train' ORDER BY split_rank LIMIT 100"),
        "first_n_rows": q("SELECT example_id, row_no FROM clean ORDER BY row_no LIMIT 100"),
        # step 6: profile
        "instruction_profile": q("SELECT instruction, min(row_no) AS first_row, count(*) AS n FROM raw GROUP BY instruction"),
        "instruction_preview": q("""
SELECT instruction, first_row FROM (SELECT instruction, min(row_no) AS first_row FROM raw GROUP BY instruction)
ORDER BY first_row LIMIT 3"""),
        "code_count_summary": q(summary_sql("SELECT num_codes FROM clean", "num_codes")),
        "note_length_summary": q(summary_sql("SELECT length(ehr_text) AS note_len FROM clean", "note_len")),
        "token_length_summary": q(summary_sql(f"""
SELECT 'prompt_token_length' AS metric, {tokens('prompt_text')} AS value FROM sample_
UNION ALL SELECT 'full_text_token_length', {tokens('text')} FROM sample_
UNION ALL SELECT 'num_codes_per_example', num_codes FROM sample_""", "value", by="metric").replace(
            ", src AS (", ", sample_ AS (SELECT * FROM clean), src AS (", 1)),
        # step 7: evaluate
        "example_metrics": q("""
SELECT example_id, precision, recall, f1, exact_match, np AS num_predicted_codes, nr AS num_reference_codes FROM m3"""),
        "macro_metrics": q("""
SELECT round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1,
       round(avg(exact_match), 9) AS exact_match, round(avg(np), 9) AS num_predicted_codes,
       round(avg(nr), 9) AS num_reference_codes FROM m3"""),
        "micro_metrics": q("""
, sums AS (SELECT sum(tp) AS tp, sum(np) AS np, sum(nr) AS nr FROM m3),
r AS (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p, CASE WHEN nr > 0 THEN tp / nr ELSE 0.0 END AS rc FROM sums)
SELECT CAST(tp AS BIGINT) AS true_positives, CAST(np AS BIGINT) AS predicted_codes, CAST(nr AS BIGINT) AS reference_codes,
       round(p, 9) AS micro_precision, round(rc, 9) AS micro_recall,
       round(CASE WHEN p + rc = 0 THEN 0.0 ELSE 2.0 * p * rc / (p + rc) END, 9) AS micro_f1 FROM r"""),
        "evaluation_row": q(_evaluation_select()),
        "metrics_by_split": q(_evaluation_select("split")),
        "prediction_rows": q("SELECT example_id, prompt_text, target_text AS reference, prediction FROM per_row"),
        "prediction_gaps": q("""
, r AS (SELECT example_id FROM splits WHERE split = 'test'),
given AS (
  SELECT example_id FROM splits WHERE split = 'test' AND row_no % 11 <> 0
  UNION ALL SELECT example_id FROM splits WHERE split = 'validation' AND row_no % 3 = 0
  UNION ALL SELECT example_id FROM splits WHERE split = 'test' AND row_no % 7 = 1 AND row_no % 11 <> 0),
p AS (SELECT example_id, count(*) AS c FROM given GROUP BY 1)
SELECT (SELECT count(*) FROM r) AS "references", (SELECT count(*) FROM given) AS predictions,
       (SELECT count(*) FROM r WHERE example_id NOT IN (SELECT example_id FROM p)) AS missing_predictions,
       (SELECT count(*) FROM p WHERE example_id NOT IN (SELECT example_id FROM r)) AS extra_predictions,
       CAST(0 AS BIGINT) AS repeated_references, (SELECT count(*) FROM p WHERE c > 1) AS repeated_predictions"""),
        # step 8: checks
        "template_check": q(f"""
SELECT CAST(count(*) AS BIGINT) AS "rows",
       CAST(count(*) FILTER (WHERE NOT coalesce(contains(text, {lit(T.response_template)}), false)) AS BIGINT) AS rows_without_template
FROM clean"""),
        "request_check": f"""
WITH req AS ({REQUESTS}), v AS (SELECT request_id, {_violations()} AS violations FROM req)
SELECT request_id, len(violations) = 0 AS valid, array_to_string(violations, '|') AS violations FROM v""",
        "over_budget": q(f"""
, f AS (SELECT split, {tokens('prompt_text')} > 1024 AS over_ FROM splits)
SELECT split, CAST(count(*) AS BIGINT) AS "rows", CAST(count(*) FILTER (WHERE over_) AS BIGINT) AS over_budget,
       round(CAST(count(*) FILTER (WHERE over_) AS DOUBLE) / count(*), 9) AS share_over_budget FROM f GROUP BY split"""),
        "length_buckets": q(f"""
SELECT CAST(floor({tokens('text')} / 128) AS BIGINT) AS length_bucket, count(*) AS n FROM clean GROUP BY 1"""),
        # step 9: score
        "batch_predict": q(SCORED + "\nSELECT row_no, normalized_prediction AS prediction FROM scored"),
        "parse_predictions": q(f"""
SELECT example_id, {strip('prediction')} AS raw_prediction, {canon(strip('prediction'))} AS normalized_prediction,
       array_to_string({extract(strip('prediction'))}, '|') AS codes FROM preds"""),
        # step 10: io, stream
        "save_and_reload_split": q("SELECT example_id, split_key, target_text, row_no FROM splits WHERE split = 'test'"),
        "jsonl_notes": q(SCORED + "\nSELECT row_no, normalized_prediction FROM scored"),
        "load_or_prepare": q("SELECT example_id, split FROM splits"),
        "note_files": q(f"SELECT row_no, {strip('ehr_text')} AS note FROM raw WHERE ehr_text IS NOT NULL"),
        "stream_score": q(SCORED.replace("FROM raw)", "FROM raw WHERE ehr_text IS NOT NULL)")
                          + "\nSELECT row_no, normalized_prediction FROM scored"),
        "dataset_report": _report_sql(),
        "report_json": _report_sql(),
        "report_time": "SELECT count(*) AS rows, true AS is_utc_text, true AS is_now FROM documents",
        "raw_split": q("""
SELECT f.fmt, ehr_text, instruction, output, icd_code FROM raw, (SELECT unnest(['json', 'parquet']) AS fmt) f WHERE icd_code IS NOT NULL"""),
        "batch_inference": q(SCORED.replace("SELECT row_no,", "SELECT sha256(ehr_text) AS note_hash,").replace("FROM raw)", "FROM raw WHERE ehr_text IS NOT NULL)")
                             + "\nSELECT note_hash, normalized_prediction FROM scored"),
        "nested_json": q("SELECT row_no, array_to_string(target_codes, '|') AS codes, ehr_text AS note, true AS is_null FROM u"),
        "token_template": q("""
, w AS (SELECT row_no, list_transform(string_split(ehr_text, ' '), lambda x_: length(x_)) AS ids FROM s)
SELECT row_no, len(list_filter(range(1, len(ids)), lambda i_: ids[i_] = 2 AND ids[i_ + 1] = 3)) > 0 AS has_run FROM w"""),
        "empty_training": q("""
SELECT (SELECT count(*) FROM splits WHERE split = 'train') AS train_rows, v.c AS "check", v.f AS fails
FROM (VALUES ('empty_training', true), ('training', false), ('ratios_over_one', true), ('ratios', false)) v(c, f)"""),
        "tokenizer_counts": q("SELECT row_no, len(list_filter(regexp_split_to_array(ehr_text, '\\s+'), lambda x_: x_ <> '')) AS n_tokens FROM s"),
        "length_order": q("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM clean"),
        "length_batches": q(f"""
, b AS (SELECT example_id, {tokens('text')} AS n_tokens, row_number() OVER (ORDER BY sha256('{BATCHES.seed}:' || example_id)) - 1 AS r FROM splits WHERE split = 'train')
, g AS (SELECT *, r // {MEGA} AS mega FROM b)
, a AS (SELECT *, row_number() OVER (PARTITION BY mega ORDER BY n_tokens DESC, r) - 1 AS at_ FROM g)
SELECT example_id, n_tokens, CAST(mega * {BATCHES.mega_batches} + at_ // {BATCHES.batch_size} AS BIGINT) AS batch,
       CAST(at_ % {BATCHES.batch_size} AS INTEGER) AS place FROM a"""),
        "cut_prompts": q(f"""
, w AS (SELECT row_no, full_prompt, regexp_extract_all(full_prompt, '[ \t\n\x0B\f\r]*(?:{APPROX_TOKEN_PATTERN})') AS toks FROM up)
SELECT row_no, sha256(CASE WHEN len(toks) > 256 THEN array_to_string(toks[1:256], '') ELSE full_prompt END) AS seen_hash, len(toks) > 256 AS was_cut FROM w"""),
        "stream_settings": f"""
WITH req AS ({REQUESTS}), v AS (SELECT *, {_violations()} AS violations FROM req)
SELECT request_id AS row_no, concat(max_new_tokens, ' ', num_beams, ' ', request_id % 25, ' ', request_id % 13, ' ', CASE WHEN request_id % 2 = 0 THEN 1 ELSE 0 END) AS raw_prediction
FROM v WHERE len(violations) = 0""",
        "evaluation_file": q(_evaluation_select("split").replace(
            "FROM m3 GROUP BY split",
            "FROM (SELECT m3.* FROM m3 JOIN splits USING (example_id) WHERE m3.split = 'test') GROUP BY split")),
    }
    return {k: v.strip() for k, v in sql.items()}
