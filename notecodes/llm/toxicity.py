"""Toxicity scores from a misspelling-tolerant lexicon and its context (operator 5).

* The lexicon is mined from labelled training texts: words, and stems
  (beginnings of words), that occur far more often in toxic texts.
* Its trie is intersected with the Levenshtein automaton of distance 1 (letters put in, left out,
  replaced, or two neighbours swapped), which gives one deterministic automaton; a word is read once
  and yields its term and distance. A stem with an edit takes any rest of the word, too. Tasks run it over all words of a slice at once (one table
  lookup per character position).
* Every hit is scored in its context window: a hit inside quotation marks
  within ``WINDOW`` characters counts as quoted, others as abuse. Fuzzy hits
  count by how well each term's misspellings tell the classes apart.
* A logistic model over these counts, fitted on the training sample with a
  prior for cases the sample lacks, gives the score.

``TRAIN_ROWS`` bounds the labelled rows that the model is fitted on, and so the lexicon: it has every term
of the sample whose odds are significant, however rare or long. Every document is scored over its whole text.

Defined cases: null and empty texts have no hits and get the model's base
score. Without labels of both classes the lexicon is empty and the score is the
share of toxic labels, 0 without any. Repeated rows and ids are scored row by row. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import held_out, kept_rows, labelled_sample, scored, setup, staged

TRAIN_ROWS, WINDOW = 30_000, 48
STEMS = (4, 5, 6)
#: Shorter terms are matched exactly only.
FUZZY_FROM = 5
#: A term is so many times as frequent in toxic training texts as in others, at least, and its log-likelihood ratio
#: against equal frequency (G squared) is so large: 6e-7 by chance, and few words are frequent enough to reach it.
LEAST_RATIO, LEAST_G2 = 8.0, 25.0

#: Log-odds from which a term's misspellings count like the term.
TRUSTED = 2.0

_WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "\"“«„‟❝", "\"”»“‟❞"
_INSIDE = "@$*"
_CLASSES = 0x110000


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(_CLASSES)), bool, _CLASSES)


def _folded() -> np.ndarray:
    table = np.arange(_CLASSES, dtype=np.int32)
    for c in range(_CLASSES):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


_tables: dict[str, np.ndarray] = {}


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points and text offsets in them."""
    if not _tables:
        _tables["letter"], _tables["low"] = _letters(), _folded()
    cps = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    return _tables["low"][cps], begins[offsets]


def word_runs(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of letter and digit runs; a mask character between letters belongs to its word."""
    n = len(cps)
    inside = np.zeros(n + 1, bool)
    inside[:n] = _tables["letter"][cps]
    if n > 2:
        mask = np.isin(cps[1:-1], [ord(c) for c in _INSIDE])
        inside[1: n - 1] |= mask & inside[: n - 2] & inside[2:n]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    return np.flatnonzero(inside & (~before | cut)), np.flatnonzero(before & (~inside | cut))


@dataclass
class Automaton:
    """Lexicon trie x Levenshtein(1), made deterministic. ``step[state, class]``; state 0 is dead.

    ``hit[state]``: 0 none, 1 exact, 2 one edit, 3 a stem with one edit and letters behind it; ``term[state]``;
    ``final[state]``: a stem is complete, so the rest of the word does not matter.
    """

    classes: np.ndarray
    step: np.ndarray
    hit: np.ndarray
    term: np.ndarray
    final: np.ndarray

    def read(self, cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The state after each word."""
        state = np.ones(len(start), np.int32)
        live = np.arange(len(start))
        at = start.copy()
        kind = self.classes[cps]
        while len(live):
            state[live] = self.step[state[live], kind[at]]
            at = at + 1
            go = (state[live] != 0) & ~self.final[state[live]] & (at < end[live])
            live, at = live[go], at[go]
        return state


def build_automaton(terms: list[tuple[str, bool]]) -> Automaton:
    """``terms``: (lower-cased word or stem, whether it is a stem)."""
    children: list[dict[str, int]] = [{}]
    ends: list[list[tuple[int, bool]]] = [[]]
    for i, (text, stem) in enumerate(terms):
        node = 0
        for c in text:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({}), ends.append([])
            node = children[node][c]
        ends[node].append((i, stem))
    alphabet = sorted({c for text, _ in terms for c in text})
    classes = np.zeros(_CLASSES, np.int16)
    for i, c in enumerate(alphabet):
        classes[ord(c)] = i + 1

    # besides trie nodes, a state can hold a stem that was met with an edit (it stays, whatever follows), and
    # a swap that waits for its second letter
    many = len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    near_stem = lambda i: -1 - i
    swap = lambda node, c: -1 - len(terms) - node * many - place[c]

    def closed(found: dict[int, int]) -> tuple[tuple[int, int], ...]:
        for node, edits in list(found.items()):
            if node >= 0 and edits == 0:  # a letter of the term is missing in the word
                for child in children[node].values():
                    found.setdefault(child, 1)
        return tuple(sorted(found.items()))

    def after(state: tuple[tuple[int, int], ...], c: str | None) -> tuple[tuple[int, int], ...]:
        found: dict[int, int] = {}
        stems: list[int] = []
        for node, edits in state:
            if node < -len(terms):
                target, first = divmod(-1 - len(terms) - node, many)
                if c == alphabet[first]:
                    found.setdefault(target, 1)
                continue
            if node < 0:
                stems.append(-1 - node)
                continue
            if c is not None and c in children[node]:
                child = children[node][c]
                found[child] = min(edits, found.get(child, 2))
            if edits == 0:  # a letter too many, or another letter, or two swapped
                for other in (node, *children[node].values()):
                    found[other] = min(1, found.get(other, 2))
                for first, child in children[node].items():
                    if c is not None and first != c and c in children[child]:
                        found[swap(children[child][c], first)] = 1
            else:
                stems += [i for i, stem in ends[node] if stem and len(terms[i][0]) >= FUZZY_FROM]
        if stems:
            found[near_stem(min(stems))] = 1  # the most frequent one
        return closed(found)

    def verdict(state: tuple[tuple[int, int], ...]) -> tuple[int, int, bool]:
        best = (0, 0, False)
        for node, edits in state:
            if -len(terms) <= node < 0:
                heard = [(3, -1 - node, False)]
            elif node >= 0:
                heard = [(1 + edits, i, stem and edits == 0) for i, stem in ends[node] if edits == 0 or len(terms[i][0]) >= FUZZY_FROM]
            else:
                continue
            for got in heard:
                if not best[0] or got[0] < best[0]:
                    best = got
        return best

    def letters(state: tuple[tuple[int, int], ...]) -> set[str]:
        """Those that are not read like any other letter."""
        out: set[str] = set()
        for node, edits in state:
            if node < -len(terms):
                out.add(alphabet[(-1 - len(terms) - node) % many])
            elif node >= 0:
                out.update(children[node])
                if edits == 0:
                    for child in children[node].values():
                        out.update(children[child])
        return out

    ids: dict[tuple, int] = {(): 0, closed({0: 0}): 1}
    order = list(ids)
    rows, done = [np.zeros(len(alphabet) + 1, np.int32)], 1
    while done < len(order):
        state = order[done]
        done += 1
        row = np.zeros(len(alphabet) + 1, np.int32)

        def of(target: tuple) -> int:
            if target not in ids:
                ids[target] = len(order)
                order.append(target)
            return ids[target]

        row[:] = of(after(state, None))
        for c in sorted(letters(state)):
            row[classes[ord(c)]] = of(after(state, c))
        rows.append(row)
    said = [verdict(s) for s in order]
    return Automaton(classes, np.array(rows), np.array([x[0] for x in said]), np.array([x[1] for x in said]), np.array([x[2] for x in said]))


def quoted(cps: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each span stands between quotation marks no farther than WINDOW characters within its text."""
    out = np.zeros(len(start), bool)
    if not len(start):
        return out
    text_of = np.searchsorted(offsets, start, "right") - 1
    for i, (a, b, t) in enumerate(zip(start.tolist(), end.tolist(), text_of.tolist())):
        left = "".join(map(chr, cps[max(offsets[t], a - WINDOW): a]))
        right = "".join(map(chr, cps[b: min(offsets[t + 1], b + WINDOW)]))
        opened = max(left.rfind(c) for c in _OPEN)
        closed = max(left.rfind(c) for c in _CLOSE if c not in _OPEN)
        straight = left.count('"') % 2 == 1
        after = any(c in right for c in _CLOSE)
        out[i] = after and opened > closed and (straight or left[opened] != '"')
    return out


@dataclass
class Model:
    """Lexicon, automaton and logistic weights; ``trust`` is each term's log-odds when misspelled (row 0), and
    when misspelled with letters behind it (row 1)."""

    terms: list[tuple[str, bool]]
    base: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(7))
    trust: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))

    def __post_init__(self):
        self.automaton = build_automaton(self.terms)

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, kind, quoted) of every hit, and the texts' word counts. Kinds: 0 exact, 1 an edit, 2 a stem with an edit and a rest."""
        cps, bounds = code_points(data, offsets)
        start, end = word_runs(cps, bounds)
        state = self.automaton.read(cps, start, end)
        found = np.flatnonzero(self.automaton.hit[state])
        text = np.searchsorted(bounds, start[found], "right") - 1
        in_quotes = quoted(cps, bounds, start[found], end[found])
        words = np.diff(np.searchsorted(start, bounds))
        return text, self.automaton.term[state[found]], self.automaton.hit[state[found]] - 1, in_quotes, words

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        text, term, edits, in_quotes, words = self.hits(data, offsets)
        count = lambda pick: np.bincount(text[pick], minlength=n).astype(float)
        trust = self.trust[np.maximum(edits - 1, 0), term] if self.trust.size else np.ones(len(term))
        # a misspelling that clean texts do not have counts like the term itself
        trusted = (edits == 0) | (trust >= TRUSTED if self.trust.size else False)
        exact, exact_quoted = count(trusted & ~in_quotes), count(trusted & in_quotes)
        fuzzy = np.zeros(n)
        pick = ~trusted & ~in_quotes
        np.maximum.at(fuzzy, text[pick], trust[pick])
        return np.column_stack([
            np.ones(n), np.minimum(exact, 1), np.log1p(exact), np.minimum(exact_quoted, 1), np.log1p(exact_quoted),
            fuzzy, np.log1p(exact) / np.log(words + 10.0),
        ])

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not self.terms:
            return np.full(n, self.base)
        return 1 / (1 + np.exp(-np.clip(self.features(data, offsets) @ self.weights, -30, 30)))


#: Prior mean of the weights: base, any exact hit, log count, any quoted hit, its log count, fuzzy trust, density.
_PRIOR = np.array([-3.0, 3.0, 1.0, 0.5, 0.3, 1.0, 0.0])


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, spread: float = 2.0, rounds: int = 50) -> np.ndarray:
    """Maximum a posteriori weights by Newton steps (Gaussian prior)."""
    def value(v: np.ndarray) -> float:
        z = x @ v
        return float(np.sum(y * z - np.logaddexp(0, z)) - np.sum((v - prior) ** 2) / (2 * spread**2))

    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - (w - prior) / spread**2
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / spread**2
        move, at = np.linalg.solve(hess, grad), value(w)
        size = 1.0  # a full step can overshoot where the classes are nearly separate
        while size > 1e-6 and value(w + size * move) < at:
            size /= 2
        w = w + size * move
        if np.abs(move).max() < 1e-6 or size <= 1e-6:
            break
    return w


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest shingle hash of each text: near copies mostly share it."""
    for batch in batches:
        for part in tn.slices(batch, "text"):
            data, offsets = tn.buffer_of(part.column("text"))
            sets = tn.shingle_sets(tn.words_of(tn.lower_ascii(data), offsets, tn.NON_SPACE))
            least = np.array([s[0] if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("text"), part.column("label"), pa.array(least)], ["text", "label", "sketch"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text", 4 << 20):
            counts = (Counter(), Counter())
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                words = set(_WORD.findall(text.lower()))
                stems = {w[:k] + "*" for k in STEMS for w in words if len(w) > k}
                counts[label > 0].update(words | stems)
            terms = list(counts[1].keys() | counts[0].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
                ["term", "toxic", "clean"],
            )


def mine_lexicon(sample: DataFrame, toxic: int, clean: int) -> list[tuple[str, bool]]:
    """Terms that mark toxic texts, the most frequent first; a term that another one covers is left out.

    ``sample`` is bounded, and so are its terms.
    """
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    both = (t + c) / (toxic + clean)
    part = lambda k, n: F.when(k > 0, k * F.log(k / (n * both))).otherwise(0.0)
    g2 = 2 * (part(t, toxic) + part(c, clean) + part(toxic - t, toxic * (1 - both) / both) + part(clean - c, clean * (1 - both) / both))
    found = (
        sample.select("text", "label").mapInArrow(_term_counts, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((t * clean >= LEAST_RATIO * toxic * c) & (F.col("toxic") > 1) & (g2 >= LEAST_G2)).collect()
    )
    rank = sorted(found, key=lambda r: (-r["toxic"], r["term"].endswith("*"), -len(r["term"]), r["term"]))
    # how often the most frequent longer term of a stem occurs (the whole word counts as longer)
    longer: dict[str, int] = {}
    for r in found:
        text, stem = r["term"].rstrip("*"), r["term"].endswith("*")
        for k in STEMS:
            if len(text) > k or (len(text) == k and not stem):
                longer[text[:k]] = max(longer.get(text[:k], 0), r["toxic"])
    kept: list[tuple[str, bool]] = []
    for r in rank:
        text, stem = r["term"].rstrip("*"), r["term"].endswith("*")
        if stem and longer.get(text, 0) >= 0.9 * r["toxic"]:
            continue  # the more specific term says the same
        if any(text.startswith(t) if s else t == text for t, s in kept):
            continue
        kept.append((text, stem))
    return kept


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, train_rows: int = TRAIN_ROWS) -> Model:
    """The model learned from labels whose id's remainder is not the held-out one."""
    setup(docs.sparkSession)
    # of near copies one is enough: terms that a group of copies has alone are no evidence
    sample = labelled_sample(docs, labels, "toxic", mod, rest, train_rows).select("text", "label").mapInArrow(_sketched, "text string, label int, sketch long")
    sample = staged(sample.groupBy("label", "sketch").agg(F.max("text").alias("text")).select("text", "label"), "toxic_sample")
    n = {r["y"]: r["c"] for r in sample.groupBy((F.col("label") > 0).alias("y")).agg(F.count("*").alias("c")).collect()}
    toxic, clean = n.get(True, 0), n.get(False, 0)
    terms = mine_lexicon(sample, toxic, clean) if toxic and clean else []
    model = Model(terms, toxic / max(1, toxic + clean))
    if not terms:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text"):
                data, offsets = tn.buffer_of(part.column("text"))
                x = model.features(data, offsets)
                text, term, edits, in_quotes, _ = model.hits(data, offsets)
                pick = (edits > 0) & ~in_quotes
                kind = (edits - 1) * len(terms) + term  # a place in ``trust``
                near = [np.unique(kind[pick & (text == i)]).tolist() if pick.any() else [] for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(near, pa.list_(pa.int32()))], ["label", "x", "near"]
                )

    # bounded by the sample
    got = sample.select("text", "label").mapInArrow(run, "label int, x array<double>, near array<int>").toArrow()
    y = (got.column("label").to_numpy() > 0).astype(float)
    x = np.array(got.column("x").to_pylist())
    near = got.column("near").to_pylist()
    seen = np.zeros((2, 2 * len(terms)))
    bare = x[:, 1] == 0  # an exact hit would take a fuzzy one's credit
    for label, terms_near, ok in zip(y.astype(int), near, bare):
        if ok:
            seen[label, terms_near] += 1
    # odds of the texts without an exact hit; what no text of the sample has is taken for a misspelling
    trust = np.where(seen.sum(axis=0) == 0, TRUSTED, np.clip(np.log(seen[1] + 0.5) - np.log(seen[0] + 0.5), 0, 8))
    model.trust = trust.reshape(2, len(terms))
    x[:, 5] = [max((trust[t] for t in terms_near if trust[t] < TRUSTED), default=0.0) for terms_near in near]
    model.weights = fit_logistic(x, y, _PRIOR)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    model = fit(docs, labels, mod, rest)
    return scored(docs, model).select(
        "doc_id", held_out("doc_id", mod, rest).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    return kept_rows(docs, fit(docs, labels, mod, rest), lambda s: s < 0.5)
