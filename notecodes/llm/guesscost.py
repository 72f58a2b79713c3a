"""Secret scans by password guess cost (operator 12).

Two kinds of finds: patterns of well-known secrets (``assign``, ``access``, ``hex``), and values in
a credential context whose guess cost is high (``guess``). The cost, log10 of the guesses that
an attacker needs, is the cheapest segmentation of the value into

* words: rank by count among all words of the corpus (or in a short list of common
  passwords), with upper-case letters and look-alike digits as variations,
* dates: day, month and year in usual orders, or a year,
* repeats of a unit, keyboard walks (alphabet and digit rows too), and
* brute-force spans over the kinds of characters that the value has.

Each segment also costs the choice of its kind. "changeme", "qwerty123" or a word of the text
cost little and are left alone; random or unusual values are reported.

1. A pass over whole texts finds the patterns and the credential-context values.
2. Words are counted over whole texts without those values, so that a secret is not
   its own dictionary. A word's rank is the number of words with at least its count
   (by a histogram of counts of fixed size).
3. Distinct values are cut into the pieces that could be words; pieces are joined with
   the counts, and each value is costed once, however often it is copied. The join's keys are
   distinct per value; costs go back by value.

The time is linear in the value's length (words have at most ``WORD_MOST`` code points; repeats and walks
are tried from their first or up to their last place). No value or text is cut.

Defined cases: null and empty texts have no spans. Each row is judged by itself, also with a repeated or
null doc_id; repeated rows give repeated results. A context value inside a pattern's span
is not reported twice. Positions are code points. Empty tables give no rows.
Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date
from math import comb, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import setup, staged

#: log10 of the guesses from which a value is a secret; shorter values than VALUE_LEAST are never one.
COST_LEAST, VALUE_LEAST = 10.0, 6
WORD_LEAST, WORD_MOST, WORD_COUNT = 3, 24, 2
KINDS = ("assign", "access", "hex", "guess")

_SLICE = 1 << 20

# Patterns run on bytes with A-Z lower-cased where letters may have either case.
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_VALUE = rb"(?:\"([^\"\s]+)\"|'([^'\s]+)'|`([^`\s]+)`|([^\s\"'`<>]+))"
_CONTEXT = re.compile(
    rb"(?:(?:pass(?:word|wd|phrase|code|wort)|kennwort|secret|token|credentials?|(?:api|access|private|secret|encryption)[_ -]?key|contrase\xc3\xb1a|mot de passe"
    rb"|(?<![a-z])(?:pwd|pass|auth|login|clave|schl\xc3\xbcssel))[\"']?\s{0,8}(?:=>|->|:=|[:=])\s{0,8}|(?<![a-z])bearer\s{1,8})" + _VALUE
    + rb"|://[^\s/@:\"']+:([^\s/@\"']+)@"
)
_TAIL = b".,;:!?)]}"

#: Common passwords and placeholders, most usual first.
COMMON = (
    "password pass admin root login user guest test changeme letmein welcome secret default master monkey dragon sunshine princess football baseball "
    "iloveyou shadow superman batman hello freedom whatever trustno starwars access flower passw pwd token key example sample dummy placeholder your "
    "here none null true false required hidden redacted passwort geheim motdepasse contrase clave hallo bonjour hola"
).split()
#: Rows of keys of three keyboards, from the digits down (a key touches its neighbours and two keys of the next row), and the alphabet.
KEYBOARDS = (
    ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"), ("1234567890", "qwertzuiop", "asdfghjkl", "yxcvbnm"),
    ("1234567890", "azertyuiop", "qsdfghjklm", "wxcvbn"), ("abcdefghijklmnopqrstuvwxyz",),
)
_LOOKS = str.maketrans("0134578@$!", "oleastbasi")
_KIND_COST = log10(5)


def _steps(rows: tuple[str, ...]) -> dict[tuple[str, str], tuple[int, int]]:
    """The direction of the step from each key to those that it touches."""
    keys = {(r, c): key for r, row in enumerate(rows) for c, key in enumerate(row)}
    ways = ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1))
    return {(key, keys[r + x, c + y]): (x, y) for (r, c), key in keys.items() for x, y in ways if (r + x, c + y) in keys}


_STEPS = [_steps(rows) for rows in KEYBOARDS]
_SHIFTED = str.maketrans("!@#$%^&*()", "1234567890")
_DATES = [re.compile(p) for p in (
    r"(?=(?P<d>\d{1,2})(?P<s>[-/._]?)(?P<m>\d{1,2})(?P=s)(?P<y>\d{4}|\d{2}))", r"(?=(?P<m>\d{1,2})(?P<s>[-/._]?)(?P<d>\d{1,2})(?P=s)(?P<y>\d{4}|\d{2}))",
    r"(?=(?P<y>\d{4}|\d{2})(?P<s>[-/._]?)(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2}))",
)]
_YEAR = re.compile(r"(?=(19\d\d|20\d\d))")


def _character_kinds(value: str) -> float:
    """log10 of the characters to choose from in a brute-force span of ``value``."""
    kinds = {"digit" if c in "0123456789" else "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "other" if ord(c) > 126 else "sign" for c in value}
    return log10(sum({"digit": 10, "lower": 26, "upper": 26, "sign": 33, "other": 100}[k] for k in kinds))


def pieces(value: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, hashes, look-alikes) of all parts of ``value`` that could be words, some thousand places at a time."""
    for kind, text in enumerate((value, value.translate(_LOOKS))):
        if kind and text == value:
            continue
        flat = tn.lower_ascii(np.frombuffer(text.encode(), np.uint8))
        at = np.flatnonzero(np.append((flat & 0xC0) != 0x80, True))
        changed = np.cumsum([0] + [x != y for x, y in zip(value, text)])
        length = np.arange(WORD_LEAST, WORD_MOST + 1)
        for run in re.finditer(r"[^\W\d_]+", text):
            for begin in range(run.start(), run.end(), 4096):
                start = np.repeat(np.arange(begin, min(begin + 4096, run.end())), len(length))
                end = start + np.tile(length, len(start) // len(length))
                swaps = changed[np.minimum(end, run.end())] - changed[start]
                use = (end <= run.end()) & (swaps > 0 if kind else True)  # without look-alikes the plain reading has it
                start, end, swaps = start[use], end[use], swaps[use]
                yield start, end, tn.span_hashes(flat[at[begin]:], at[start] - at[begin], at[end] - at[begin]).view(np.int64), swaps


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(tn.span_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])


_COMMON_RANKS = {_word_hash(w): log10(i + 1) for i, w in enumerate(COMMON)}


def _case_cost(word: str) -> float:
    """log10 of the ways to set capitals up to those of ``word``."""
    up = sum(c.isupper() for c in word)
    low = sum(c.islower() for c in word)
    if not up:
        return 0.0
    if not low or (up == 1 and (word[0].isupper() or word[-1].isupper())):
        return log10(2)
    return log10(sum(comb(up + low, i) for i in range(1, min(up, low) + 1)))


def _date_segments(value: str) -> Iterator[tuple[int, int, float]]:
    for pattern in _DATES:
        for m in pattern.finditer(value):
            year = int(m["y"]) + (0 if len(m["y"]) == 4 else 1900 if int(m["y"]) > 50 else 2000)
            if not 1900 <= year <= 2099 or not m["s"] and not (len(m["d"]) == len(m["m"]) == 2):
                continue
            try:
                date(year, int(m["m"]), int(m["d"]))
            except ValueError:
                continue
            end = m.start() + len(m["d"]) + len(m["m"]) + len(m["y"]) + 2 * len(m["s"])
            yield m.start(), end, log10(365 * max(abs(year - 2000), 20)) + (log10(4) if m["s"] else 0.0)
    for m in _YEAR.finditer(value):
        yield m.start(), m.start() + 4, log10(max(abs(int(m[1]) - 2000), 20))


def _parts(run: tuple[int, int], least: int) -> Iterator[tuple[int, int]]:
    """A run's parts from its first or up to its last place."""
    a, b = run
    yield from ((a, e) for e in range(a + least, b + 1))
    yield from ((s, b) for s in range(a + 1, b - least + 1))


def _repeat_segments(value: str, each: float) -> Iterator[tuple[int, int, float]]:
    for unit in range(1, 9):
        at = 0
        while at + unit < len(value):
            to = at + unit
            while to < len(value) and value[to] == value[to - unit]:
                to += 1
            inner = any(unit % d == 0 and value[at:at + unit] == value[at:at + d] * (unit // d) for d in range(1, unit))
            if to - at >= max(2 * unit, 3) and not inner:  # else the smaller unit has this run
                for a, b in _parts((at, to), max(2 * unit, 3)):
                    yield a, b, unit * each + log10((b - a) / unit)
            at = max(at + 1, to - unit + 1)


def _walk_segments(value: str, steps: dict[tuple[str, str], tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
    """Walks on one keyboard."""
    keys = value.translate(_SHIFTED).lower()
    if len(keys) != len(value):  # a letter whose lower case is two code points
        keys = value
    at = 0
    while at < len(value) - 2:
        to = at + 1
        while to < len(value) and (keys[to - 1], keys[to]) in steps:
            to += 1
        if to - at >= 3:
            turns, shifts = [0, 0, 0], [0]  # up to each place of the run
            for i in range(at, to):
                shifts.append(shifts[-1] + (value[i] != keys[i]))
                if i >= at + 2:
                    turns.append(turns[-1] + (steps[keys[i - 1], keys[i]] != steps[keys[i - 2], keys[i - 1]]))
            for a, b in _parts((at, to), 3):
                changes, up = turns[b - at] - turns[a - at + 2], shifts[b - at] - shifts[a - at]
                yield a, b, log10(47 * (b - a)) + changes * log10(5) + min(up, b - a - up) * log10(2) + (log10(2) if up else 0.0)
        at = max(at + 1, to - 1)


def segments(value: str, ranks: dict[int, float]) -> list[tuple[int, int, float, str]]:
    """All (start, end, cost, kind) that the segmentation may use besides brute-force spans.

    ``ranks``: log10 of the rank of words by hash, for those of the value's pieces that are words.
    """
    each = _character_kinds(value) if value else 0.0
    out = []
    known = _COMMON_RANKS | {h: min(rank, _COMMON_RANKS.get(h, rank)) for h, rank in ranks.items()}
    words = np.array(sorted(known), np.int64)
    for start, end, hashes, swaps in pieces(value):
        hit = np.isin(hashes, words)
        for a, b, h, n in zip(start[hit].tolist(), end[hit].tolist(), hashes[hit].tolist(), swaps[hit].tolist()):
            out.append((a, b, known[h] + _case_cost(value[a:b]) + n * log10(2), "word"))
    out += [(a, b, c, "date") for a, b, c in _date_segments(value)]
    out += [(a, b, c, "repeat") for a, b, c in _repeat_segments(value, each)]
    out += [(a, b, c, "walk") for steps in _STEPS for a, b, c in _walk_segments(value, steps)]
    return out


def guess_cost(value: str, ranks: dict[int, float] | None = None) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses of the cheapest segmentation of ``value``, and that segmentation as (start, end, kind)."""
    each, n = (_character_kinds(value) if value else 0.0), len(value)
    ends: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
    for a, b, cost, kind in segments(value, ranks or {}):
        ends[b].append((a, cost, kind))
    best, came = [0.0] * (n + 1), [(0, "")] * (n + 1)
    span, begun = float("inf"), 0  # the cheapest way that ends in a brute-force span, and where that began
    for i in range(1, n + 1):
        if best[i - 1] + _KIND_COST < span:
            span, begun = best[i - 1] + _KIND_COST, i - 1
        span += each
        best[i], came[i] = span, (begun, "brute")
        for a, cost, kind in ends[i]:
            if best[a] + _KIND_COST + cost < best[i]:
                best[i], came[i] = best[a] + _KIND_COST + cost, (a, kind)
    path, i = [], n
    while i > 0:
        a, kind = came[i]
        path.append((a, i, kind))
        i = a
    return best[n], path[::-1]


def found_in(raw: bytes, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, value start, value end) in bytes of a text: patterns, then context values outside them."""
    low, out = raw.lower(), []  # of bytes, only A-Z change
    marked = b"=" in raw or b":" in raw or b">" in raw  # as all but one kind of match are
    for m in _ASSIGN.finditer(low) if marked else ():
        if m.end(2) - m.start(2) >= 12:
            out.append((0, *m.span(), *m.span(2)))
    out += [(1, *m.span(), *m.span()) for m in _ACCESS.finditer(raw)]
    out += [(2, s, e, s, e) for s, e in hexes]
    base = [(s, e) for _, s, e, _, _ in out]
    for m in _CONTEXT.finditer(low) if marked or b"bearer" in low else ():
        s, e = m.span(m.lastindex)
        if m.lastindex == 4:
            e = s + len(low[s:e].rstrip(_TAIL))
        if e > s and not any(x <= s and e <= y for x, y in base):
            out.append((3, s, e, s, e))
    return sorted(out, key=lambda f: (f[1], f[0]))


_HEX = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x66 for b in range(256)])


def _finds(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int, int, int, int]]]]:
    """Bytes and offsets of the slice's texts and the finds of each, in the slice's bytes."""
    data, offsets = tn.buffer_of(part.column("text"))
    start, end = tn.word_bounds(data, offsets, _HEX)
    long = end - start >= 16
    start, end = start[long], end[long]
    first = np.searchsorted(start, offsets).tolist()
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        here = slice(first[i], first[i + 1])
        out.append([(k, *(x + a for x in at)) for k, *at in found_in(data[a:b].tobytes(), list(zip((start[here] - a).tolist(), (end[here] - a).tolist())))])
    return data, offsets, out


_FIND = "array<struct<kind:int,start:long,end:long,value:string>>"
_FIND_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text", _SLICE):
            data, offsets, finds = _finds(part)
            letters = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=letters[1:])
            rows = []
            for a, found in zip(offsets[:-1], finds):
                rows.append([
                    {"kind": k, "start": int(letters[s] - letters[a]), "end": int(letters[e] - letters[a]), "value": data[x:y].tobytes().decode(errors="replace")}
                    for k, s, e, x, y in found
                ])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, _FIND_ARROW)], ["doc_id", "finds"])


_WORD_BYTES = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text", 4 * _SLICE):
            data, offsets, finds = _finds(part)
            data = tn.lower_ascii(data)
            for found in finds:
                for _, _, _, x, y in found:
                    data[x:y] = 0x20
            words = tn.words_of(data, offsets, _WORD_BYTES)
            unique, counts = np.unique(words.hash[words.end - words.start >= WORD_LEAST], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(counts, pa.int64())], ["word", "n"])


def word_ranks(docs: DataFrame) -> DataFrame:
    """(word, rank): of each word hash that occurs often enough outside credential values, log10 of the number
    of words with at least its count (counts are binned by eighths of a power of two, at most 512 bins)."""
    counts = staged(docs.mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= WORD_COUNT), "word_counts")
    binned = counts.withColumn("bin", F.floor(F.log2("n") * 8).cast("int"))
    sizes = binned.groupBy("bin").agg(F.count("*").alias("many"))
    ranks = sizes.withColumn("rank", F.log10(F.sum("many").over(Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)).cast("double")))
    return binned.join(F.broadcast(ranks.select("bin", "rank")), "bin").select("word", "rank")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, value in zip(batch.column("id").to_pylist(), batch.column("value").to_pylist()):
            for _, _, hashes, _ in pieces(value):
                some = np.unique(hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i)), pa.array(some)], ["id", "word"])


def _costed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = []
        for value, known in zip(batch.column("value").to_pylist(), batch.column("known").to_pylist()):
            costs.append(guess_cost(value, {k["word"]: k["rank"] for k in known or ()})[0])
        yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(costs, pa.float64())], ["value", "cost"])


def value_costs(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(value, cost) of each distinct value of ``values`` (value); ``ranks``: (word, rank)."""
    ids = staged(values.select("value").distinct().withColumn("id", F.monotonically_increasing_id()), "values")
    many = ids.count()  # values are small but take long: tasks by their number
    parts = max(-(-many // 4096), min(2 * ids.sparkSession.sparkContext.defaultParallelism, 1 + many // 64))
    ids = ids.repartition(parts, "id")
    known = (
        ids.mapInArrow(_pieces, "id long, word long").hint("merge").join(ranks, "word")
        .groupBy("id").agg(F.collect_set(F.struct("word", "rank")).alias("known"))  # at most the value's own pieces
    )
    return ids.join(known, "id", "left").repartition(parts, "id").select("value", "known").mapInArrow(_costed, "value string, cost double")


def secrets(docs: DataFrame, least: float = COST_LEAST) -> DataFrame:
    """doc_id and spans (kind, start, end, value, cost; by start, then kind) of every row of ``docs`` (doc_id, text).

    Pattern finds have the guess cost of their value, too; context values are spans if theirs is at least ``least``.
    """
    setup(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = staged(rows.mapInArrow(_found, f"doc_id long, finds {_FIND}").withColumn("row", F.monotonically_increasing_id()), "finds")
    each = found.select("row", F.explode("finds").alias("find"))
    costs = value_costs(each.select("find.value"), word_ranks(rows.select("text")))
    kind = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("find.kind") + 1)
    spans = (
        each.withColumn("value", F.col("find.value")).join(costs, "value")
        .where((F.col("find.kind") < 3) | ((F.col("cost") >= least) & (F.char_length("value") >= VALUE_LEAST)))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("find.start", "find.kind", "find.end", "value", "cost", kind.alias("name")))).alias("spans"))
    )
    return found.join(spans, "row", "left").select(
        "doc_id", F.coalesce(F.transform("spans", lambda s: F.struct(s["name"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["cost"].alias("cost"))),
                             F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string,cost:double>>")).alias("spans")
    )


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
