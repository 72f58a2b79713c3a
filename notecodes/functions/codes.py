"""Diagnosis-code column builders: extraction, normalization, variants, leakage.

All builders return ``Column`` expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code pattern as Python has it, and for Spark; both are matched against upper-cased text. ``U`` is not a
# first letter. Word boundaries are written out over letters, numbers and ``_``:
# Java's own ``\b`` counts marks and joiners as word characters, and circled
# digits not. After a dot, a boundary is a word character; after any other, none.
PYTHON_CODE_PATTERN = r"\b[A-TV-Z][0-9][0-9A-Z](?:\.?[0-9A-Z]{0,4})\b"
_WORD = r"[\p{L}\p{N}_]"
CODE_PATTERN = (
    rf"(?<!{_WORD})[A-TV-Z][0-9][0-9A-Z](?:\.?[0-9A-Z]{{0,4}})(?:(?<=\.)(?={_WORD})|(?<!\.)(?!{_WORD}))"
)


def empty_codes() -> Column:
    return F.array().cast("array<string>")


def normalize_code(code: Column) -> Column:
    """Canonical form of one code, for any input string.

    Upper-case, keep ``[A-Za-z0-9.]``, collapse ``..`` pairs once, drop all dots
    if more than one is left, put the dot after the third character of the head
    (the head is cut to three characters), then strip trailing dots.
    """
    cleaned = F.regexp_replace(F.upper(code), r"[^A-Za-z0-9.]", "")
    single = F.replace(cleaned, F.lit(".."), F.lit("."))
    n_dots = F.length(single) - F.length(F.replace(single, F.lit("."), F.lit("")))
    dotless = F.replace(single, F.lit("."), F.lit(""))
    dot_at = F.instr(single, ".")

    def dotted_after_three(s: Column) -> Column:
        return F.concat(F.substring(s, 1, 3), F.lit("."), s.substr(F.lit(4), F.length(s)))

    head = F.substring_index(single, ".", 1)
    tail = single.substr(dot_at + 1, F.length(single))
    shaped = (
        F.when(n_dots > 1, F.when(F.length(dotless) > 3, dotted_after_three(dotless)).otherwise(dotless))
        .when(dot_at == 0, F.when(F.length(single) > 3, dotted_after_three(single)).otherwise(single))
        .otherwise(F.concat(F.substring(head, 1, 3), F.lit("."), tail))
    )
    return F.when(cleaned == "", F.lit("")).otherwise(F.rtrim(shaped, F.lit(".")))


def extract_codes(text: Column) -> Column:
    """Distinct canonical codes in first-seen order; null or empty text gives ``[]``.

    Matches are joined with ``;`` (never part of a match) and normalized on that
    short string in one pass: a match is three characters, an optional dot and
    up to four more, so its canonical form is the first three characters, a dot,
    the rest, with a trailing dot dropped. No lambda is involved, so the whole
    projection stays in whole-stage codegen.
    """
    matches = F.regexp_extract_all(F.upper(F.coalesce(text, F.lit(""))), F.lit(CODE_PATTERN), 0)
    joined = F.array_join(matches, ";")
    dotted = F.regexp_replace(joined, r"([^;]{3})\.?([^;]*)", "$1.$2")
    canonical = F.regexp_replace(dotted, r"\.(;|$)", "$1")
    return F.array_distinct(F.array_remove(F.split(canonical, ";"), ""))


def codes_to_text(codes: Column) -> Column:
    """Canonical code text: codes joined by ``", "`` (``[]`` gives ``""``)."""
    return F.array_join(codes, ", ")


def canonical_text(text: Column) -> Column:
    """Free text to its canonical code string."""
    return codes_to_text(extract_codes(text))


def code_variants(code: Column) -> Column:
    """Dotted and undotted forms of a code; ``[]`` when it normalizes to empty."""
    n = normalize_code(code)
    return F.when(n == "", empty_codes()).otherwise(F.array_distinct(F.array(n, F.replace(n, F.lit("."), F.lit("")))))


# A code-shaped string at any place of upper-cased text, found by looking ahead, so that overlapping ones are seen too.
# It is as long as can be, so a code that stands at that place is one of its beginnings.
_SHAPE_AHEAD = r"(?=([A-TV-Z][0-9][0-9A-Z]\.?[0-9A-Z]{0,4}))"
_BEGINNINGS = r"([^;]{3})([^;]?)([^;]?)([^;]?)([^;]?)([^;]?);"


def code_beginnings(upper_text: Column) -> Column:
    """Every string of upper-cased text that could be a code (dotted or not), wherever it stands.

    One scan of the text for any number of codes. The rest works on the short list of matches,
    without a lambda, so the projection stays in whole-stage codegen.
    """
    shapes = F.array_join(F.regexp_extract_all(upper_text, F.lit(_SHAPE_AHEAD), 1), ";")
    each = F.regexp_replace(F.concat(shapes, F.lit(";")), _BEGINNINGS, "$1;$1$2;$1$2$3;$1$2$3$4;$1$2$3$4$5;$1$2$3$4$5$6;")
    return F.array_remove(F.split(each, ";"), "")


def leaks_in_upper(upper_text: Column, codes: Column) -> Column:
    """True when any code, dotted or undotted, is a substring of ``upper_text``.

    ``upper_text`` is already upper-cased; ``codes`` are canonical codes (as made
    by ``extract_codes``), a fixed point of normalization, so a code's variants are itself
    and itself without the dot. Substring match, no word boundary: the text's code-shaped
    strings and all their beginnings are met with the row's variants. Pass a column (not an
    expression) as ``upper_text`` so the upper-casing runs once per row.
    """
    joined = F.array_join(codes, ";")
    variants = F.split(F.concat(joined, F.lit(";"), F.replace(joined, F.lit("."), F.lit(""))), ";")
    empty = (F.coalesce(upper_text, F.lit("")) == "") | (F.coalesce(F.size(codes), F.lit(0)) == 0)
    return F.when(empty, F.lit(False)).otherwise(F.arrays_overlap(code_beginnings(upper_text), variants))


def leaks(text: Column, codes: Column) -> Column:
    """The leakage test on text as it is."""
    return leaks_in_upper(F.upper(text), codes)
