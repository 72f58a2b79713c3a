"""Document fingerprints by one-permutation MinHash (operator 1). Built-in functions only.

A text's word 5-shingles (the whole sequence when it has fewer words) are hashed
once; the high bits of a hash choose one of ``BINS`` bins and each bin keeps its
smallest value. Empty bins are filled by optimal densification: bin ``i`` takes
the value of the first non-empty bin among those that a hash of ``i`` and the
number of the try names. Of every bin ``BITS`` low-order bits of the value are stored, packed as hex
digits; likeness corrects the share of equal digits for chance agreement.

Everything is array expressions on the row: no shuffle, no Python.

Defined cases: null texts are empty. A text without words has the fingerprint
"" (likeness 1 to another such text, 0 to others). Equal texts have equal
fingerprints. For the edited texts of ``edited_fingerprints`` rows are ordered
by descending doc_id, equal ids by their text, null ids last; a single row is its own next
row, an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROBES = 16
BINS, BITS, WORDS = 256, 4, 5  # sixteen 64-bit words of sixteen 4-bit digits
#: Documents ordered together in one window group, about; and the most groups.
GROUP, MOST_GROUPS = 500, 1 << 16

_SHIFT = 56  # the eight high bits of a hash (as signed numbers, in order) are its bin, the others its value
_EMPTY = (1 << _SHIFT) - 1


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``<name>_code`` (64-bit words of packed digits, empty without words) of column ``text``."""
    p = f"_{name}_"
    keep = [F.col(c) for c in df.columns]
    # steps are columns of their own, so that no expression is computed twice or inside a lambda
    step = df.select(*keep, F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), "").alias(p + "w"))
    step = step.select(*keep, F.transform(p + "w", lambda w: F.xxhash64(w)).alias(p + "h"))
    h = F.col(p + "h")
    # a shingle's hash starts at each word; behind the last words there is nothing to add (nulls are skipped)
    every = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, WORDS))))
    step = step.select(*keep, F.slice(every, F.lit(1), F.greatest(F.size(h) - (WORDS - 1), F.lit(1))).alias(p + "g"))
    # with one end marker per bin, the first hash of each bin after sorting is its minimum, or the marker of an empty bin
    ends = F.lit((np.arange(BINS, dtype=np.int64) - BINS // 2) * (1 << _SHIFT) + _EMPTY)
    step = step.select(*keep, F.size(p + "g").alias(p + "n"), F.sort_array(F.concat(p + "g", ends)).alias(p + "s"))
    s = F.col(p + "s")
    bin_of = lambda v: F.shiftright(v, _SHIFT)
    firsts = F.filter(s, lambda v, i: ~bin_of(v).eqNullSafe(bin_of(F.get(s, i - 1))))
    step = step.select(*keep, F.col(p + "n"), F.transform(firsts, lambda v: F.when(v.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, v)).alias(p + "b"))
    b = F.col(p + "b")
    # a bin's lenders are tried in its own random order (coalesce stops at the first); texts of few
    # shingles, where many tries fail, take the non-empty bin of the smallest hash with this one
    step = step.select(*keep, F.col(p + "n"), b, F.array_compact(b).alias(p + "f"))
    tries = lambda i: (F.get(b, F.xxhash64(i, F.lit(a)).bitwiseAND(BINS - 1).cast("int")) for a in range(PROBES))
    least = lambda i: F.array_min(F.transform(p + "f", lambda v: F.struct(F.xxhash64(i, bin_of(v)).alias("h"), v.alias("v"))))["v"]
    filled = F.transform(b, lambda v, i: F.coalesce(v, *tries(i), least(i)))
    step = step.select(*keep, F.col(p + "n"), filled.alias(p + "v"))
    per_word = 64 // BITS
    word = lambda w: F.aggregate(
        F.slice(p + "v", w * per_word + 1, F.lit(per_word)), F.lit(0).cast("long"), lambda x, v: F.shiftleft(x, BITS).bitwiseOR(v.bitwiseAND((1 << BITS) - 1))
    )
    # v is named twice: the optimizer would compute a column that is named once inside the lambda, for each word anew
    code = F.when((F.col(p + "n") > 0) & (F.size(p + "v") == BINS), F.transform(F.lit(np.arange(BINS // per_word, dtype=np.int32)), word)).otherwise(F.array().cast("array<bigint>"))
    return step.select(*keep, code.alias(f"{name}_code"))


def as_text(code: Column) -> Column:
    """The packed digits as a hex string."""
    return F.array_join(F.transform(code, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two codes: equal digits, corrected for chance agreement."""
    def unequal(w: int) -> Column:  # digits of word w that differ: any of a digit's four bits
        x = F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111).cast("long")))

    equal = 1 - reduce(lambda x, y: x + y, (unequal(w) for w in range(BINS // 16))) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    return (
        F.when(a == b, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))
    )


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` (doc_id and ``carried`` columns) with each carried column of the next row in
    descending doc_id order as ``next_<column>``; the last row's next is the first.

    Rows are grouped between exact ids of the table (quantiles, at most
    MOST_GROUPS of them). A group's largest id is known, so its row is also
    sent to the group above, whose last row it follows: one shuffle, no global order in one task.
    """
    rows, = docs.agg(F.count("doc_id")).first()
    groups = max(1, min(MOST_GROUPS, rows // GROUP))
    found = docs.agg(F.percentile_approx("doc_id", [i / groups for i in range(1, groups + 1)], max(10_000, 4 * groups)).alias("q")).first()["q"]
    bounds = sorted(set(found or []))
    if bounds:
        bounds[-1] = docs.agg(F.max("doc_id")).first()[0]
    side = max(1, math.isqrt(len(bounds)))
    first, every = F.lit(np.array(bounds[::side] or [0], np.int64)), F.lit(np.array(bounds or [0], np.int64))
    # the group of an id is the number of bounds below it, searched block by block
    block = F.greatest(F.size(F.filter(first, lambda x: x < F.col("doc_id"))) - 1, F.lit(0))
    placed = docs.withColumn("block", F.coalesce(block, F.lit(0)))
    inside = F.size(F.filter(F.slice(every, F.col("block") * side + 1, side), lambda x: x < F.col("doc_id")))
    placed = placed.withColumn("group", F.coalesce(F.col("block") * side + inside, F.lit(0)))
    # a head also follows the last row of the next group; the whole table's head follows the first group's
    is_head = F.coalesce(F.get(every, F.col("group")) == F.col("doc_id"), F.lit(not bounds))
    own = F.struct(F.col("group").alias("group"), F.lit(0).alias("follows"))
    above = F.struct(F.pmod(F.col("group") + 1, F.lit(max(1, len(bounds)))).alias("group"), F.lit(1).alias("follows"))
    copies = F.when(is_head, F.array(own, above)).otherwise(F.array(own))
    spread = placed.select("doc_id", *carried, F.explode(copies).alias("to")).select("doc_id", *carried, F.col("to.group").alias("group"), F.col("to.follows").alias("follows"))
    order = Window.partitionBy("group").orderBy("follows", F.desc_nulls_last("doc_id"), *carried)
    ahead = spread.select("doc_id", *carried, "follows", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried))
    return ahead.where("follows = 0").drop("follows")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, fingerprint_code of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return with_fingerprint(rows, "text", "fingerprint").select("doc_id", "text", as_text(F.col("fingerprint_code")).alias("fingerprint"), "fingerprint_code")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = with_next(with_fingerprint(rows, "text", "own"), ["text", "own_code"]).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    step = with_fingerprint(both.select("doc_id", "n_chars", "own_code", "next_own_code", edited.alias("edited")), "edited", "edited")
    return step.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("own_code")).alias("fingerprint"), as_text(F.col("edited_code")).alias("edited_fingerprint"),
        likeness(F.col("own_code"), F.col("edited_code")).alias("near_edited"),
        likeness(F.col("own_code"), F.col("next_own_code")).alias("near_next"),
    )
