"""String helpers that reproduce Python text semantics with JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``):
# U+0009..U+000D, U+001C..U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000. Zero-width space and BOM are not in it.
PY_SPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
STRIP_PATTERN = rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$"

# The same fixed set as characters, for ``trim(BOTH chars FROM str)``.
PY_SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def py_strip(col: Column) -> Column:
    """``str.strip()`` on a string column (plain ``trim`` only removes U+0020).

    ``trim`` with a character set removes any of those characters from both
    ends, walking UTF-8 characters and touching only the ends of the text; the
    regex form (``STRIP_PATTERN``, used by the SQL oracle) gives the same result.
    """
    return F.trim(col, F.lit(PY_SPACE_CHARS))


def clean_text(col: Column) -> Column:
    """``(value or "").strip()``: null becomes the empty string, then strip."""
    return py_strip(F.coalesce(col, F.lit("")))
