"""One hot duplicate holding a third of the rows: results stay whole and exact.

The raw table is derived from ``documents``: every third row carries the same
note and label as row 0. The Spark result is compared with a brute-force
Python rendering of the rules over the same rows (first-seen dedup in row order).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from notecodes.functions.codes import PYTHON_CODE_PATTERN
from notecodes.operators import clean
from tests.conftest import SF001

_PAT = re.compile(PYTHON_CODE_PATTERN)


def _codes(text):
    out = []
    for m in _PAT.findall((text or "").upper()):
        d = m.replace(".", "")
        c = f"{d[:3]}.{d[3:]}" if len(d) > 3 else d
        if c not in out:
            out.append(c)
    return out


def _brute(rows):
    seen, kept = set(), []
    for r in sorted(rows, key=lambda r: r["row_no"]):
        note = (r["ehr_text"] or "").strip()
        codes = _codes(r["output"]) or _codes(r["icd_code"])
        target = ", ".join(codes)
        if not note or not target:
            continue
        up = note.upper()
        if any(c in up or c.replace(".", "") in up for c in codes):
            continue
        eid = hashlib.sha256(f"{note}|||{target}".encode()).hexdigest()
        if eid in seen:
            continue
        seen.add(eid)
        kept.append((eid, r["row_no"]))
    return sorted(kept)


def test_hot_duplicate(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    hot = docs.withColumn("hot", docs.where(F.col("doc_id") == 0).select("text").scalar())
    raw = hot.select(
        F.col("doc_id").alias("row_no"),
        F.when(F.col("doc_id") % 3 == 0, F.col("hot")).otherwise(F.col("text")).alias("ehr_text"),
        F.lit("List the codes.").alias("instruction"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("Codes: K21.9")).otherwise(
            F.concat(F.lit("Codes: M"), F.lpad((F.col("doc_id") % 90 + 10).cast("string"), 2, "0"), F.lit(".1"))
        ).alias("output"),
        F.lit(None).cast("string").alias("icd_code"),
    )
    got = clean.clean_rows(clean.classify(raw)).select("example_id", "row_no").collect()
    want = _brute([r.asDict() for r in raw.collect()])
    assert sorted((r.example_id, r.row_no) for r in got) == want
    stats = {r.stat: r.n for r in clean.cleaning_stats(clean.classify(raw)).collect()}
    assert stats["rows_seen"] == 1000
    assert stats["duplicate_rows"] >= 333 - 1
