"""Spelling variant grouping by permuterm rotations (operator 13).

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased; a word counts when
it is long and frequent enough. Two words are near when one inserted, deleted or
replaced code point turns one into the other. A word's form is its near word of
largest count, if that is several times its own; its root is the last form that is reached.

1. Words are counted by Spark from whole texts. Runs, their CRC-32 and their counts in a slice
   come from whole-buffer numpy operations. The deletions that the ``rule`` asks for are made here.
2. A word with its terminator, ``w$``, is written out in all rotations. The rotation that ends in
   the code point c at place i is ``y$x`` + c for w = x c y: all words that differ from w there
   by a replacement share the prefix ``y$x``, and the word ``xy`` has ``y$x`` as a whole rotation.
   So a replacement and an indel are one range of the sorted rotations, that of a prefix
   without the edited code point.
3. Rotations are dealt by prefix and sorted; a scan takes one range after the other. A range holds at
   most one word for each letter of the alphabet and one whole rotation, so no
   range grows with the corpus. A pair with equal letters side by side (``aab``, ``ab``) meets in
   several ranges; it is counted where the deleted letter leads its run.
4. Every word leaves a range with its neighbours' number and the best of them, not with all
   pairs; these are added up by word. Roots come by pointer jumping; counts grow by the
   factor along forms, so chains have no cycles and are logarithmic in the largest count.

Prefixes of more than ``LONGEST`` code points are replaced by a 122-bit digest, so that a very
long word costs its length and not its square; ranges stay whole.

Defined cases: null and empty texts have no words. A null doc_id counts as empty text in the rule.
Repeated rows count as often as they occur. Ties go to the smaller word in code-point
order. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import setup, staged

LEAST_LETTERS, LEAST_COUNT, FACTOR = 6, 5, 5
#: One in so many (document, run) pairs loses a code point.
EDITED = 199
TERMINATOR = "$"
#: Code points of a rotation that is kept as text.
LONGEST = 64

_SLICE = 4 << 20
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b == 0xC3 for b in range(256)])
_IN_RUN = np.array([False, True])
_MODULI, _BASES = ((1 << 61) - 1, (1 << 61) - 31), (1_000_003, 7_368_787)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of maximal runs; U+00C0 to U+00FF are the byte C3 and one more."""
    inside = _LETTER[data]
    inside[1:] |= data[:-1] == 0xC3
    return tn.word_bounds(inside.astype(np.uint8), offsets, _IN_RUN)


def run_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span, carried on from ``state`` (the CRC of what stands before it)."""
    crc = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    length = end - start
    order = np.argsort(-length, kind="stable")
    many = np.searchsorted(-length[order], -np.arange(65))  # spans of more than j bytes come first
    for j in range(64):
        now = order[: many[j]]
        if not len(now):
            break
        crc[now] = _CRC[(crc[now] ^ data[start[now] + j]) & np.uint32(255)] ^ crc[now] >> np.uint32(8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in order[: many[64]]:
        crc[i] = zlib.crc32(data[start[i] + 64: end[i]].tobytes(), int(crc[i]))
    return crc


def texts_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow string array."""
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    at = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())


def _counted(least: int, edited: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                data, offsets = tn.buffer_of(part.column("text"))
                data = tn.lower_ascii(data)
                start, end = letter_runs(data, offsets)
                letters = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=letters[1:])
                length = letters[end] - letters[start]
                fits = length >= least
                start, end, length = start[fits], end[fits], length[fits]
                ids = ["" if i is None else str(i) for i in part.column("doc_id").to_pylist()]
                state = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
                crc = run_crcs(data, start, end, state[np.searchsorted(offsets, start, "right") - 1])
                cut = np.flatnonzero(crc % np.uint32(edited) == 0)
                shorter = []
                for i in cut[length[cut] > least]:
                    word, at = data[start[i]: end[i]].tobytes().decode(), int(crc[i]) % int(length[i])
                    shorter.append(word[:at] + word[at + 1:])
                keep = np.ones(len(start), bool)
                keep[cut] = False
                start, end = start[keep], end[keep]
                unique, example, counts = np.unique(tn.span_hashes(data, start, end), return_index=True, return_counts=True)
                words = pa.concat_arrays([texts_of(data, start[example], end[example]), pa.array(shorter, pa.string())])
                yield pa.RecordBatch.from_arrays([words, pa.array(np.append(counts, np.ones(len(shorter), np.int64)), pa.int64())], ["word", "n"])

    return run


def word_counts(docs: DataFrame, least: int = LEAST_LETTERS, edited: int = EDITED) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text) with at least ``least`` code points.

    A run of a document whose CRC-32 of ``<doc_id>:<run>`` is divisible by ``edited`` loses its code point at
    that CRC modulo its length.
    """
    setup(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_counted(least, edited), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def prefixes(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(prefix, whole, leads) of every rotation of ``word`` and its terminator: each one without its last code point,
    which is not the terminator, and each whole one. ``leads``: the edited code point is the first of its run."""
    size = len(word)
    short = lambda n: n <= LONGEST
    if not short(size + 1):
        places = [_Digest(word, m, b) for m, b in zip(_MODULI, _BASES)]
    for i in range(size):
        key = word[i + 1:] + TERMINATOR + word[:i] if short(size) else "".join(f"{d.rotation(i + 1, i):016x}" for d in places)
        yield key, False, i == 0 or word[i] != word[i - 1]
    for i in range(size + 1):
        yield (word[i:] + TERMINATOR + word[:i] if short(size + 1) else "".join(f"{d.rotation(i, i):016x}" for d in places)), True, False


class _Digest:
    """Polynomial digests of a word's rotations, each in constant time."""

    def __init__(self, word: str, modulus: int, base: int) -> None:
        self.word, self.modulus, self.power, self.head = word, modulus, [1], [0]
        for c in word:
            self.power.append(self.power[-1] * base % modulus)
            self.head.append((self.head[-1] * base + ord(c) + 1) % modulus)
        self.base = base

    def rotation(self, at: int, to: int) -> int:
        """Of word[at:] + terminator + word[:to]."""
        tail = (self.head[-1] - self.head[at] * self.power[len(self.word) - at]) % self.modulus
        marked = (tail * self.base + ord(TERMINATOR) + 1) % self.modulus
        return (marked * self.power[to] + self.head[to]) % self.modulus


_POSTED = "key string, id long, n long, whole boolean, leads boolean"


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "id", "n", "whole", "leads"])

    for batch in batches:
        rows: list[tuple] = []
        for i, word, n in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            for key, whole, leads in prefixes(word):
                rows.append((key, i, n, whole, leads))
                if len(rows) >= 50_000:
                    yield out(rows)
                    rows = []
        if rows:
            yield out(rows)


def scan(key: np.ndarray, ids: np.ndarray, n: np.ndarray, whole: np.ndarray, leads: np.ndarray) -> pa.RecordBatch:
    """One row for each member of a range with others: its neighbours' number there and the best of them.
    ``key`` numbers the ranges in ascending order."""
    order = np.lexsort((ids, -n, key))
    key, ids, n, whole, leads = (x[order] for x in (key, ids, n, whole, leads))
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(key)))
    group = np.repeat(np.arange(len(begin)), size)
    replaced = np.bincount(group, weights=~whole, minlength=len(begin)).astype(np.int64)[group]
    leading = np.bincount(group, weights=leads, minlength=len(begin)).astype(np.int64)[group]
    near = np.where(whole, leading, replaced - 1 + (leads & (size[group] > replaced)))
    first = begin[group]
    best = np.where(np.arange(len(key)) == first, first + 1, first)  # the best one, or the second for the best itself
    many = size[group] > 1
    best = best[many]
    return pa.RecordBatch.from_arrays([pa.array(ids[many]), pa.array(near[many]), pa.array(n[best]), pa.array(ids[best])], ["id", "near", "best_n", "best"])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of sorted rotations; the last range of a batch may go on in the next one and waits for it."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = (pa.concat_tables([held, now]) if held is not None else now).combine_chunks()
        at = _range_numbers(now)
        cut = int(np.searchsorted(at, at[-1]))
        held = now.slice(cut)
        yield _scan_table(now.slice(0, cut), at[:cut])
    if held is not None:
        yield _scan_table(held, _range_numbers(held))


def _range_numbers(rows: pa.Table) -> np.ndarray:
    keys = rows.column("key").combine_chunks()
    keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
    same = pa.compute.equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False).astype(bool)
    return np.concatenate(([0], np.cumsum(~same)))


def _scan_table(rows: pa.Table, at: np.ndarray) -> pa.RecordBatch:
    column = lambda c: rows.column(c).to_numpy()
    return scan(at, column("id"), column("n"), column("whole").astype(bool), column("leads").astype(bool))


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n): ids in the code-point order of the words (UTF-8 sorts alike)."""
    return staged(words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best) of each of ``words`` (id, word, n) that has near words; ``best``: the one of largest n."""
    setup(words.sparkSession)
    rotations = words.select("id", "word", "n").mapInArrow(_posted, _POSTED)
    found = rotations.repartition("key").sortWithinPartitions("key").mapInArrow(_scanned, "id long, near long, best_n long, best long")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max(F.struct(F.col("best_n"), (-F.col("best")).alias("minus"))).alias("b")).select(
        "id", "n_near", F.col("b.best_n").alias("best_n"), (-F.col("b.minus")).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of each row of ``forms`` (id, form): where its forms lead at last. Each round doubles the steps taken."""
    found = staged(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = found.select(F.col("id").alias("root"), F.col("root").alias("next"))
        done = staged(found.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        found = done.select("id", "root")
        if done.where("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, factor: int = FACTOR, **rule) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text) that occurs often enough."""
    words = numbered(word_counts(docs, **rule).where(F.col("n") >= least_count))
    near = staged(
        words.join(neighbours(words), "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                *(F.when(F.col("best_n") >= factor * F.col("n"), F.col(c)).alias(a) for c, a in (("best", "form_id"), ("best_n", "form_n")))),
        "near",
    )
    named = words.select("id", "word")
    changed = near.where("form_id IS NOT NULL")
    last = roots(changed.select("id", F.col("form_id").alias("form")))
    named_forms = (
        changed.select("id", "form_id").join(last, "id")
        .join(named.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
        .join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
        .select("id", "form", "root_word")
    )
    return near.join(named_forms, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
