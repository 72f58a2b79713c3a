"""Expression goldens (FIXTURES.md section 4)."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from notecodes.functions.codes import CODE_PATTERN, PYTHON_CODE_PATTERN, code_variants, extract_codes, leaks, normalize_code
from notecodes.functions.metrics import example_metrics
from notecodes.functions.prompts import DEFAULT_SYSTEM_PROMPT, DEFAULT_TEMPLATE
from notecodes.functions.text import STRIP_PATTERN, clean_text
from tests.conftest import one_col

MATCHES = [
    ("E11.9, I10", ["E11.9", "I10"]),
    ("e11.9", ["E11.9"]),
    ("E119", ["E119"]),
    ("E11.9ABCDE", ["E11."]),
    ("E11. next", ["E11"]),
    ("U07.1", []),
    ("xE11.9", []),
    ("E11_9", []),
    ("éE11.9 x", []),
    ("E11.9é", ["E11."]),
    ("A01..2", ["A01"]),
    ("E11.9-S72.001A", ["E11.9", "S72.001A"]),
    ("H2O A1B.C", ["H2O", "A1B.C"]),
    ("E11.9.1", ["E11.9"]),
    ("E1190.1", ["E1190"]),
    ("E11\u0301", ["E11"]),
    ("x\u200dE11.9", ["E11.9"]),
    ("E11.9\u2460", ["E11."]),
    ("\u0301E11.9\u0301", ["E11.9"]),
    ("E11.9\u00b2", ["E11."]),
    ("\u2460E11.9", []),
    ("E11.\u0301", ["E11"]),
    ("E11\u200c9", ["E11"]),
]


def test_raw_matches(spark):
    df = one_col(spark, [t for t, _ in MATCHES])
    got = df.select(F.regexp_extract_all(F.upper("t"), F.lit(CODE_PATTERN), 0).alias("m")).collect()
    assert [r.m for r in got] == [m for _, m in MATCHES]


def test_boundaries_are_pythons(spark):
    """Every case above, against Python's own word boundary."""
    pattern = re.compile(r"\b[A-TV-Z][0-9][0-9A-Z](?:\.?[0-9A-Z]{0,4})\b")
    assert [pattern.findall(t.upper()) for t, _ in MATCHES] == [m for _, m in MATCHES]


NORMALIZED = [
    ("e11.9", "E11.9"), ("E119", "E11.9"), ("E11.", "E11"), ("E11..9", "E11.9"), ("E.1.19", "E11.9"),
    ("E1190.1", "E11.1"), ("I10", "I10"), ("-", ""), ("...", ""),
]


def test_normalize_code(spark):
    df = one_col(spark, [a for a, _ in NORMALIZED])
    got = [r.n for r in df.select(normalize_code(F.col("t")).alias("n")).collect()]
    assert got == [b for _, b in NORMALIZED]


def test_extract_is_normalized_distinct_in_order(spark):
    df = one_col(spark, ["i10 E119 e11.9 I10 Z99.9", "", None, "none"])
    got = [r.c for r in df.select(extract_codes(F.col("t")).alias("c")).collect()]
    assert got == [["I10", "E11.9", "Z99.9"], [], [], []]


def test_canonical_text_is_idempotent(spark):
    from notecodes.functions.codes import canonical_text

    df = one_col(spark, [t for t, _ in MATCHES])
    once = canonical_text(F.col("t"))
    rows = df.select(once.alias("a"), canonical_text(once).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_code_variants(spark):
    df = one_col(spark, ["E11.9", "I10", "-"])
    got = [r.v for r in df.select(code_variants(F.col("t")).alias("v")).collect()]
    assert got == [["E11.9", "E119"], ["I10"], []]


LEAKS = [
    ("seen e119 today", ["E11.9"], True),
    ("ref AI100", ["I10"], True),
    ("E11 only", ["E11.9"], False),
    ("", ["I10"], False),
    ("any", [], False),
    (None, ["I10"], False),
    ("x K21 y", ["A00", "B01.2", "C02", "D03", "E04.5", "K21"], True),  # found beyond the slots
    ("x K219 y", ["A00", "B01.2", "C02", "D03", "E04.5", "K21.9"], True),
    ("x K2 y", ["A00", "B01.2", "C02", "D03", "E04.5", "K21.9"], False),
    ("x D03 y", ["A00", "B01.2", "C02", "D03", "E04.5", "K21.9"], True),
]


def test_leakage(spark):
    df = spark.createDataFrame([(t, c) for t, c, _ in LEAKS], "t string, c array<string>")
    got = [r.l for r in df.select(leaks(F.col("t"), F.col("c")).alias("l")).collect()]
    assert got == [x for _, _, x in LEAKS]


def test_leakage_scans_upper_text_once(spark):
    df = spark.createDataFrame([("a b", ["E11.9", "I10"])], "t string, c array<string>")
    plan = df.select(leaks(F.col("t"), F.col("c")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


METRICS = [
    ("E119 I10", "I10, E11.9", (1.0, 1.0, 1.0, 1.0)),
    ("E11.9", "E11.9, I10", (1.0, 0.5, 2 / 3, 0.0)),
    ("none", "I10", (0.0, 0.0, 0.0, 0.0)),
    ("none", "", (0.0, 0.0, 0.0, 1.0)),
]


def test_example_metrics(spark):
    df = spark.createDataFrame([(p, r) for p, r, _ in METRICS], "p string, r string")
    m = example_metrics(extract_codes(F.col("p")), extract_codes(F.col("r")))
    rows = df.select(*[m[k].alias(k) for k in ("precision", "recall", "f1", "exact_match")]).collect()
    for row, (_, _, want) in zip(rows, METRICS):
        assert tuple(row) == pytest.approx(want)


STRIPS = ["\u3000\u65e5\u672c \u2003", "\U0001F600 x \U0001F600", "  a b  ", "\t\nx\u3000", " y\u0085", "\u200bz\u200b", "\ufeffw", " \x1c\x1fv\x1e ", "\u00a0q\u2028", "", "   ", None]


def test_strip_matches_python(spark):
    df = one_col(spark, STRIPS)
    rows = df.select(clean_text(F.col("t")).alias("a"),
                     F.regexp_replace(F.coalesce("t", F.lit("")), STRIP_PATTERN, "").alias("b")).collect()
    assert [r.a for r in rows] == [(s or "").strip() for s in STRIPS]
    assert [r.b for r in rows] == [(s or "").strip() for s in STRIPS]


def test_space_set_is_pythons():
    from notecodes.functions.text import PY_SPACE_CHARS

    assert sorted(PY_SPACE_CHARS) == sorted(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def test_default_prompt_has_no_code_like_word():
    assert not re.search(PYTHON_CODE_PATTERN, DEFAULT_SYSTEM_PROMPT.upper())
    assert DEFAULT_TEMPLATE.isolates_fields()


def test_leakage_equals_brute_force_for_any_number_of_codes(spark):
    rng = random.Random(11)
    code = lambda: rng.choice("AB") + rng.choice("01") + rng.choice("0A") + rng.choice(["", ".1", ".A1", ".1A00"])
    rows = []
    for _ in range(400):
        codes = list(dict.fromkeys(code() for _ in range(rng.randint(0, 12))))
        parts = [rng.choice([code(), code().replace(".", ""), "E1", "x", " ", ".", "1", "A", "é", "\n", ";"]) for _ in range(rng.randint(0, 9))]
        rows.append(("".join(parts), codes))
    want = [any(v in t.upper() for c in codes for v in (c, c.replace(".", ""))) if t else False for t, codes in rows]
    assert 50 < sum(want) < 350
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(rows)], "i int, t string, c array<string>")
    got = {r.i: r.l for r in df.select("i", leaks(F.col("t"), F.col("c")).alias("l")).collect()}
    assert [got[i] for i in range(len(rows))] == want
