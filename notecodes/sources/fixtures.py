"""Fixture views derived from the driver's tables.

The driver's tables hold no code-like text, so the raw examples take their codes
from ``documents.n_chars`` (see FIXTURES.md). Exact copies in ``documents`` share
``n_chars`` and so become real duplicates. Everything is a lazy projection of the
``documents`` scan: it grows with the table and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.sources.tables import read_table

_CODES = [
    "doc_id", "text", "n_chars",
    "concat(chr(CAST(65 + n_chars % 20 AS INT)), lpad(CAST(n_chars % 100 AS STRING), 2, '0'), '.', "
    "CAST(n_chars % 10 AS STRING)) AS c1",
    "concat(chr(CAST(65 + n_chars % 19 AS INT)), lpad(CAST((n_chars * 3) % 100 AS STRING), 2, '0'), "
    "CAST(n_chars % 7 AS STRING)) AS c2",
]

_RAW = [
    "doc_id AS row_no",
    """CASE WHEN doc_id % 37 = 5 THEN '   '
            WHEN doc_id % 41 = 6 THEN CAST(NULL AS STRING)
            WHEN doc_id % 23 = 7 THEN concat(text, ' Coded ', replace(c1, '.', ''), ' today')
            ELSE concat('  ', text, ' ') END AS ehr_text""",
    """CASE WHEN doc_id % 13 = 3 THEN concat('Sample answer: ', lower(c1))
            WHEN doc_id % 5 = 0 THEN CAST(NULL AS STRING)
            WHEN doc_id % 5 = 1 THEN '  '
            WHEN doc_id % 5 = 2 THEN 'List the codes.'
            ELSE ' Assign codes. ' END AS instruction""",
    """CASE WHEN doc_id % 17 = 4 THEN CAST(NULL AS STRING)
            WHEN n_chars % 3 = 0 THEN concat(lower(c1), ' and ', c2, ', ', c1)
            WHEN doc_id % 29 = 8 THEN 'none'
            ELSE concat('Codes: ', c1, '.') END AS output""",
    """CASE WHEN doc_id % 17 = 4 AND doc_id % 2 = 0 THEN 'n/a'
            WHEN doc_id % 7 = 2 THEN c2
            WHEN doc_id % 29 = 8 THEN ''
            WHEN n_chars % 3 = 0 THEN concat(c1, '; ', c2)
            ELSE replace(c1, '.', '') END AS icd_code""",
]


def raw_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_no, ehr_text, instruction, output, icd_code`` built from ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return docs.selectExpr(*_CODES).selectExpr(*_RAW)


def fixture_predictions(clean: DataFrame) -> DataFrame:
    """Deterministic predictions over clean rows, by ``row_no % 5``.

    0: the target; 1: ``Codes: <first code>, Z99.9``; 2: ``none``; 3: the target
    lower-cased without dots; 4: the last code twice, separated by a space.
    Needs ``example_id, row_no, target_text, target_codes``.
    """
    codes = F.col("target_codes")
    first = F.get(codes, 0)
    last = F.get(codes, F.size(codes) - 1)
    k = F.col("row_no") % 5
    prediction = (
        F.when(k == 0, F.col("target_text"))
        .when(k == 1, F.concat(F.lit("Codes: "), first, F.lit(", Z99.9")))
        .when(k == 2, F.lit("none"))
        .when(k == 3, F.lower(F.replace(F.col("target_text"), F.lit("."), F.lit(""))))
        .otherwise(F.concat(last, F.lit(" "), last))
    )
    return clean.select("example_id", prediction.alias("prediction"))


def notes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Note rows for batch scoring (``note``, optional ``instruction``) from the raw fixture."""
    raw = raw_examples(spark, sf_dir)
    return raw.select("row_no", F.col("ehr_text").alias("note"), "instruction")


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests derived from ``documents``, some of them out of range."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return docs.select(
        F.col("doc_id").alias("request_id"),
        F.when(F.col("doc_id") % 31 == 3, F.lit(None).cast("string")).otherwise(F.col("text")).alias("note"),
        F.when(F.col("doc_id") % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("List the codes.")).alias("instruction"),
        (F.col("n_chars") % 160).cast("int").alias("max_new_tokens"),
        ((F.col("doc_id") % 25).cast("double") / 10.0).alias("temperature"),
        ((F.col("doc_id") % 13).cast("double") / 10.0).alias("top_p"),
        (F.col("doc_id") % 2 == 0).alias("do_sample"),
        (F.col("doc_id") % 10).cast("int").alias("num_beams"),
    )
