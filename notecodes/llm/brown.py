"""Brown class-based n-gram scores (operator 2).

score(text) = sum over tokens of log10 P(class | class before) + log10 P(token | class).
Tokens are words `[^\\x20\\x09-\\x0D]+` (A-Z lower-cased) and one end per text.

* Counts: every distinct word of the training texts is counted by Spark (64-bit word
  hashes; the table grows with the corpus).
* The classes' frame: words of at least ``UNIT_SHARE`` of all training tokens are units of their
  own, all others stand together by form (last three bytes and a flag, hashed to ``FORMS``).
  Exchange clustering assigns these bounded units to ``CLASSES`` classes: each half-round Spark
  counts every unit's neighbour classes over all unit bigrams (a table of units x classes
  comes back), and half of the units move to the class that raises the bigram likelihood most.
  The start is a k-means over the neighbour counts; the end is where a round adds
  less than ``LEAST_GAIN`` bits of mutual information between neighbouring classes.
* Every other counted word, however rare, then gets a class of its own by the same gain: Spark gathers
  each word's neighbour classes (two bytes an occurrence, dealt and sorted by word), to
  which its form's neighbours count as ``PRIOR`` more occurrences. So the words with a class grow with
  the corpus; unseen words have their form's class.
* Transitions are counted with the classes of the looked-up words (below) and of the other words' forms, and smoothed
  with the class unigram; within a class a token has
  (c + 0.5) / (class tokens + 0.5 * (class words + 1)), unseen words c = 0.
* Scoring: words of at least ``KNOWN_SHARE`` of the training tokens (a bounded table of counts and classes) are
  looked up inside the tasks. Each text's other words go to a join on the word with
  the words' table (no counted word there is frequent) and back by text, and bigrams of two
  such words to a join for either word.

Defined cases: null and empty texts are one end token. Rows with the same id and
text get equal results, one row each; rows of one id with different texts are scored by
their text. A null doc_id is in training. Extra columns are not read. An empty
training set gives every token count 0 and a base score over an empty vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import held_out, setup, staged

UNIT_SHARE, KNOWN_SHARE = 1 / (1 << 13), 1 / (1 << 20)
FORMS, CLASSES, SMOOTH, PRIOR = 1024, 48, 20.0, 2.0
#: Exchange ends when two half-rounds add less than this many bits; the bound on half-rounds guards against cycles.
LEAST_GAIN, MOST_TURNS = 0.0005, 40

#: Codes of a neighbour's class in six bits; this one says that the neighbour's class is in the join.
_JOINED = 63

_SLICE = 4 << 20
_FORM_SHIFT = np.uint64(64 - 10)

# kinds of rows that carry a text's own values past the join
_TOKENS, _KNOWN, _BASE, _MODEL, _COPIES, _PAIR = -1, -2, -3, -4, -5, -6


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, tn.Words]:
    data, offsets = tn.buffer_of(batch.column("text"))
    data = tn.lower_ascii(data)
    return data, offsets, tn.words_of(data, offsets, tn.NON_SPACE)


def forms_of(data: np.ndarray, words: tn.Words) -> np.ndarray:
    """Form bucket of each word: last three bytes and whether it starts with a letter."""
    start, last = words.start, words.end - 1
    back = lambda k: np.where(last - k >= start, data[np.maximum(last - k, 0)], 0).astype(np.uint64)
    letter = ((data[start] >= 0x61) | (data[start] >= 0x80)).astype(np.uint64)
    key = back(0) | back(1) << np.uint64(8) | back(2) << np.uint64(16) | letter << np.uint64(24)
    return (tn.mix64(key + np.uint64(3)) >> _FORM_SHIFT).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text", _SLICE):
            data, _, words = _words(part)
            unique, counts = np.unique(words.hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(counts, pa.int64())], ["word", "n"])


@dataclass
class Units:
    """Unit ids: 0 the end, 1 + i the i-th own word (sorted by hash), then the forms."""

    words: np.ndarray

    @property
    def size(self) -> int:
        return 1 + len(self.words) + FORMS

    def of(self, hashes: np.ndarray, forms: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return 1 + forms
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, 1 + at, 1 + len(self.words) + forms)


def _tokens(words: tn.Words, values: np.ndarray, end) -> np.ndarray:
    """The words' values with each text's end put in."""
    ends = words.first[1:] + np.arange(len(words.first) - 1)
    out = np.full(len(values) + len(ends), end, values.dtype)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = values
    return out


def _token_units(units: Units, data: np.ndarray, words: tn.Words) -> np.ndarray:
    """Units of all tokens of a slice: each text's words, then its end (0)."""
    return _tokens(words, units.of(words.hash, forms_of(data, words)) if len(words.hash) else np.zeros(0, np.int64), 0)


def _bigrams(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                data, _, words = _words(part)
                token = _token_units(units, data, words)
                before = np.concatenate(([0], token[:-1]))  # a text starts behind an end
                pair, n = np.unique(before * units.size + token, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n, pa.int64())], ["pair", "n"])

    return run


def _neighbours(size: int, classes: np.ndarray, many: int):
    """Per unit: how often each class follows (columns 0..) and precedes (columns many..) it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * 2 * many)
        for batch in batches:
            pair, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
            a, b = pair // size, pair % size
            total += np.bincount(a * 2 * many + classes[b], weights=n, minlength=len(total))
            total += np.bincount(b * 2 * many + many + classes[a], weights=n, minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used].astype(np.int64))], ["at", "n"])

    return run


def neighbour_counts(bigrams: DataFrame, size: int, classes: np.ndarray, many: int) -> np.ndarray:
    got = bigrams.select("pair", "n").mapInArrow(_neighbours(size, classes, many), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * 2 * many)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(size, 2 * many)


def first_classes(near: np.ndarray, many: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Weighted spherical k-means of the units' neighbour counts; class 0 is the end's alone."""
    weight = near.sum(axis=1)
    x = np.sqrt(near / np.maximum(near.sum(axis=1, keepdims=True), 1))
    live = np.flatnonzero((weight > 0) & (np.arange(len(near)) > 0))
    classes = np.ones(len(near), np.int64)
    classes[0] = 0
    if not len(live):
        return classes
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(live, size=min(many - 1, len(live)), replace=False, p=weight[live] / weight[live].sum())]
    for _ in range(rounds):
        own = (x[live] @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x[live] * np.sqrt(weight[live])[:, None])
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-12), centre)
    classes[live] = 1 + (x[live] @ centre.T).argmax(axis=1)
    return classes


def gains(classes: np.ndarray, near: np.ndarray, many: int) -> np.ndarray:
    """What one neighbour (rows: classes after, then classes before) adds to the score of each class (columns)."""
    joint = np.zeros((many, many))
    np.add.at(joint, classes, near[:, :many])
    total = joint.sum(axis=1) + 1e-9
    gain = np.log((joint + 0.1) / (total[:, None] * total[None, :] / total.sum() + 0.1))
    return np.vstack([gain.T, gain])


def exchange(classes: np.ndarray, near: np.ndarray, many: int, turn: int) -> np.ndarray:
    """One exchange round: units whose turn it is move to the class that raises
    sum N(c, d) log(N(c, d) / (N(c) N(d))) most, other units held."""
    score = near @ gains(classes, near, many)
    score[:, 0] = -np.inf  # the end keeps its class
    best = score.argmax(axis=1)
    out = classes.copy()
    move = (tn.mix64(np.arange(len(classes), dtype=np.uint64) + np.uint64(turn // 2 * 7919)) & np.uint64(1)) == np.uint64(turn & 1)
    move &= (near.sum(axis=1) > 0) & (score[np.arange(len(classes)), best] > score[np.arange(len(classes)), classes] + 1e-9)
    move[0] = False
    out[move] = best[move]
    return out


def information(classes: np.ndarray, near: np.ndarray, many: int) -> float:
    """Bits of mutual information between neighbouring classes."""
    joint = np.zeros((many, many))
    np.add.at(joint, classes, near[:, :many])
    p = joint / max(joint.sum(), 1)
    alone = p.sum(axis=1)[:, None] * p.sum(axis=0)[None, :]
    return float((p[p > 0] * np.log2(p[p > 0] / alone[p > 0])).sum())


def clustered(bigrams: DataFrame, size: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and their neighbour counts, when exchange no longer gains."""
    spread = (tn.mix64(np.arange(size, dtype=np.uint64)) % np.uint64(many - 1)).astype(np.int64) + 1
    spread[0] = 0
    classes = first_classes(neighbour_counts(bigrams, size, spread, many), many)
    near = neighbour_counts(bigrams, size, classes, many)
    bits, best = [information(classes, near, many)], (classes, near)
    for turn in range(MOST_TURNS):
        classes = exchange(classes, near, many, turn)
        near = neighbour_counts(bigrams, size, classes, many)
        bits.append(information(classes, near, many))
        if bits[-1] >= max(bits):
            best = classes, near
        if turn and bits[-1] - bits[-3] < LEAST_GAIN:
            break
    return best


def _contexts(units: Units, classes: np.ndarray):
    """(word, form, near) of a slice's words that are no units: two bytes an occurrence, the classes after and before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                data, _, words = _words(part)
                unit = _token_units(units, data, words)
                token = classes[unit]
                at = np.flatnonzero(unit > len(units.words))
                if not len(at):
                    continue
                hashes = words.hash[at - np.cumsum(unit == 0)[at]]  # a token's place less the ends before it
                order = np.argsort(hashes, kind="stable")
                at, hashes = at[order], hashes[order]
                near = np.empty((len(at), 2), np.uint8)
                near[:, 0], near[:, 1] = token[at + 1], np.where(at > 0, token[at - 1], 0)
                begin = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
                offsets = np.append(begin, len(at)).astype(np.int32) * 2
                lists = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(near.tobytes())])
                form = unit[at[begin]] - 1 - len(units.words)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[begin].view(np.int64)), pa.array(form, pa.int32()), lists], ["word", "form", "near"])

    return run


def _assigned(weights: np.ndarray, prior: np.ndarray, many: int):
    """(word, n, class) from rows sorted by word; one word's sums at a time pass from batch to batch."""

    def chosen(word: np.ndarray, form: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
        score = (near + prior[form]) @ weights
        score[:, 0] = -np.inf  # the end's own class
        n = near[:, :many].sum(axis=1).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(score.argmax(axis=1), pa.int32())], ["word", "n", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            word, form = batch.column("word").to_numpy(), batch.column("form").to_numpy()
            lists = batch.column("near")
            offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset: lists.offset + len(lists) + 1].astype(np.int64)
            near = np.frombuffer(lists.buffers()[2], np.uint8)[offsets[0]: offsets[-1]].astype(np.int64)
            new = np.concatenate(([True], word[1:] != word[:-1]))
            of = np.repeat(np.cumsum(new) - 1, np.diff(offsets) // 2) * 2 * many
            size = int(new.sum())
            total = np.bincount(np.concatenate([of + near[0::2], of + many + near[1::2]]), minlength=size * 2 * many).reshape(size, 2 * many).astype(float)
            word, form = word[new], form[new]
            if held is not None:
                if held[0][0] == word[0]:
                    total[0] += held[2][0]
                else:
                    yield chosen(*held)
            if size > 1:
                yield chosen(word[:-1], form[:-1], total[:-1])
            held = word[-1:], form[-1:], total[-1:]
        if held is not None:
            yield chosen(*held)

    return run


@dataclass
class Model:
    """Everything a task needs; all tables are bounded by KNOWN_SHARE, FORMS and CLASSES."""

    known: np.ndarray  # sorted hashes of the words looked up in the tasks
    known_count: np.ndarray
    known_class: np.ndarray
    form_class: np.ndarray  # classes of unseen words
    tokens: int
    distinct: int
    ends: int
    log_step: np.ndarray | None = None  # log10 P(class | class before); 0 beside _JOINED
    log_size: np.ndarray | None = None  # log10 of each class's emission denominator

    @property
    def log_base(self) -> float:
        return float(np.log10(max(self.tokens + 0.5 * (self.distinct + 1), 0.5)))

    def looked_up(self, data: np.ndarray, words: tn.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: whether the table has it, where, and its class (else its form's)."""
        form = forms_of(data, words) if len(words.hash) else np.zeros(0, np.int64)
        if not len(self.known):
            return np.zeros(len(form), bool), np.zeros(len(form), np.int64), self.form_class[form]
        at = np.minimum(np.searchsorted(self.known, words.hash), len(self.known) - 1)
        hit = self.known[at] == words.hash
        return hit, at, np.where(hit, self.known_class[at], self.form_class[form])


def _steps(shared, many: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(many * many, np.int64)
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                data, _, words = _words(part)
                token = _tokens(words, shared.value.looked_up(data, words)[2], 0)
                total += np.bincount(np.concatenate(([0], token[:-1])) * many + token, minlength=many * many)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["at", "n"])

    return run


def learn(train: DataFrame, counts: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and (word, n, class) of every counted word that is no unit.

    ``train``: (text) of the training rows; ``counts``: (word, n) of all their words.
    """
    ends = train.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = int(sums["n"] or 0) + ends, int(sums["v"]) + (ends > 0)
    own = counts.where(F.col("n") >= F.lit(tokens * UNIT_SHARE)).select("word", "n").toArrow()  # at most 1 / UNIT_SHARE rows
    word, n = own.column("word").to_numpy().view(np.uint64), own.column("n").to_numpy()
    order = np.argsort(word)
    units, unit_n = Units(word[order]), n[order]
    bigrams = staged(train.mapInArrow(_bigrams(units), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "bigrams")
    classes, near = clustered(bigrams, units.size, CLASSES)
    unit_class, form_class = classes[1: 1 + len(units.words)], classes[1 + len(units.words):]
    form_near = near[1 + len(units.words):]
    prior = PRIOR * form_near / np.maximum(form_near[:, :CLASSES].sum(axis=1, keepdims=True), 1)
    words = staged(
        train.mapInArrow(_contexts(units, classes), "word long, form int, near binary").repartition("word").sortWithinPartitions("word")
        .mapInArrow(_assigned(gains(classes, near, CLASSES), prior, CLASSES), "word long, n long, class int"), "classes"
    )
    rest = words.where(F.col("n") >= F.lit(tokens * KNOWN_SHARE)).toArrow()  # at most 1 / KNOWN_SHARE rows
    known = np.concatenate([units.words, rest.column("word").to_numpy().view(np.uint64)])
    order = np.argsort(known)
    model = Model(
        known[order], np.concatenate([unit_n, rest.column("n").to_numpy()])[order],
        np.concatenate([unit_class, rest.column("class").to_numpy()])[order].astype(np.int64), form_class, tokens, distinct, ends,
    )
    shared = train.sparkSession.sparkContext.broadcast(model)
    got = train.mapInArrow(_steps(shared, CLASSES), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # pairs of classes
    joint = np.zeros(CLASSES * CLASSES)
    joint[got.column("at").to_numpy()] = got.column("n").to_numpy()
    joint = joint.reshape(CLASSES, CLASSES)
    unigram = (joint.sum(axis=0) + 0.5) / (joint.sum() + 0.5 * CLASSES)
    step = (joint + SMOOTH * unigram[None, :]) / (joint.sum(axis=1, keepdims=True) + SMOOTH)
    model.log_step = np.zeros((_JOINED + 1, _JOINED + 1))
    model.log_step[:CLASSES, :CLASSES] = np.log10(step)
    total, words_in = np.zeros(CLASSES), np.zeros(CLASSES)
    total[0] = ends
    np.add.at(total, unit_class, unit_n)
    np.add.at(words_in, unit_class, 1)
    for row in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # CLASSES rows
        total[row["class"]] += row["n"]
        words_in[row["class"]] += row["v"]
    model.log_size = np.log10(total + 0.5 * (words_in + 1))
    return model, words


def _keys(part: pa.RecordBatch) -> np.ndarray:
    """A key of each row's id and text."""
    ids = part.column("doc_id")
    raw = tn.span_hashes(*_raw(part))
    return tn.mix64(ids.fill_null(0).to_numpy().view(np.uint64) + raw * tn._MIX1 + np.asarray(ids.is_null()).astype(np.uint64))


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, begins, sizes) of the equal rows of ``columns``."""
    order = np.lexsort(columns)
    if not len(order):
        return order, np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    begin = np.flatnonzero(new)
    return order, begin, np.diff(np.append(begin, len(order)))


def _scored(shared):
    """Rows for the join: a text's words outside of the table with the classes around them, and the text's own sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE // 4):
                data, _, words = _words(part)
                n, doc, key = part.num_rows, words.doc, _keys(part)
                hit, at, own_class = model.looked_up(data, words)
                token, sure = _tokens(words, own_class, 0), _tokens(words, hit, True)
                seen_class = np.where(sure, token, _JOINED)
                before = np.concatenate(([0], seen_class[:-1]))  # a text starts behind an end
                bounds = words.first + np.arange(n + 1)
                path = np.add.reduceat(model.log_step[before, seen_class], bounds[:-1])
                worth = np.zeros(len(at))
                worth[hit] = np.log10(model.known_count[at[hit]] + 0.5)
                seen = np.bincount(doc, weights=worth, minlength=n)
                size = np.bincount(doc[hit], weights=model.log_size[own_class[hit]], minlength=n)
                ends = np.log10(model.ends + 0.5)
                model_sum = path + seen - size + ends - model.log_size[0]
                base_sum = seen + ends - (words.counts + 1) * model.log_base
                known = np.bincount(doc, weights=hit, minlength=n) + (model.ends > 0)
                rare = np.flatnonzero(~hit)
                place = rare + doc[rare]  # in the tokens
                around = (before[place] * 64 + seen_class[place + 1]) * 64 + own_class[rare]
                order, begin, times = _groups(around, words.hash[rare], doc[rare])
                first = rare[order][begin]
                own = [(_TOKENS, words.counts + 1), (_KNOWN, known), (_BASE, base_sum), (_MODEL, model_sum), (_COPIES, np.ones(n))]
                spread = tn.mix64(key + np.uint64(1)).view(np.int64)  # not a word: keeps these rows dealt out evenly
                keys = np.concatenate([key[doc[first]], *(key for _ in own)]).view(np.int64)
                hashes = np.concatenate([words.hash[first].view(np.int64), *(spread for _ in own)])
                kinds = np.concatenate([times, *(np.full(n, k) for k, _ in own)]).astype(np.int32)
                values = np.concatenate([around[order][begin].astype(float), *(v.astype(float) for _, v in own)])
                id_values = pa.concat_arrays([pa.nulls(len(first) + 4 * n, pa.int64()), part.column("doc_id")])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(hashes), pa.array(kinds), pa.array(values), id_values], ["key", "word", "kind", "value", "doc_id"])

    return run


def _pairs(shared):
    """Bigrams of two words outside of the table: (key, before, word, times, form classes of both)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE // 4):
                data, _, words = _words(part)
                doc = words.doc
                hit, _, own_class = model.looked_up(data, words)
                at = np.flatnonzero(~hit[1:] & ~hit[:-1] & (doc[1:] == doc[:-1])) if len(hit) else np.zeros(0, np.int64)
                order, begin, times = _groups(words.hash[at + 1], words.hash[at], doc[at])
                first = at[order][begin]
                yield pa.RecordBatch.from_arrays([
                    pa.array(_keys(part)[doc[first]].view(np.int64)), pa.array(words.hash[first].view(np.int64)), pa.array(words.hash[first + 1].view(np.int64)),
                    pa.array(times, pa.int32()), pa.array(own_class[first] * 64 + own_class[first + 1], pa.int32()),
                ], ["key", "before", "word", "times", "forms"])

    return run


def _raw(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = tn.buffer_of(part.column("text"))
    return data, offsets[:-1], offsets[1:]


def scores(docs: DataFrame, mod: int = 5, rest: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text)."""
    setup(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = rows.where(~held_out("doc_id", mod, rest)).select("text")
    counts = staged(train.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    model, words = learn(train, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = words.where(F.col("n") < F.lit(model.tokens * KNOWN_SHARE)).select(F.col("word").alias("counted"), F.col("n").alias("c"), "class")
    log_step, log_size = F.lit(model.log_step.ravel()), F.lit(model.log_size)
    part = lambda c, at: F.shiftright(F.col(c), 6 * at).bitwiseAND(63)

    found = rows.mapInArrow(_scored(shared), "key long, word long, kind int, value double, doc_id long").withColumn(
        "around", F.when(F.col("kind") > 0, F.col("value").cast("int"))
    )
    met = found.join(others.hint("shuffle_hash"), (F.col("word") == F.col("counted")) & (F.col("kind") > 0), "left")
    own = F.coalesce("class", part("around", 0))
    met = met.select(
        "key", "doc_id", "kind", "value", (F.col("kind") > 0).alias("is_word"), F.col("c"),
        F.when(F.col("kind") > 0, F.col("kind") * (log_step[part("around", 2) * 64 + own] + log_step[own * 64 + part("around", 1)] - log_size[own])).alias("moved"),
    )
    pairs = rows.mapInArrow(_pairs(shared), "key long, before long, word long, times int, forms int")
    pairs = (
        pairs.join(others.hint("shuffle_hash"), F.col("before") == F.col("counted"), "left")
        .select("key", "word", "times", "forms", F.coalesce("class", part("forms", 1)).alias("from_class"))
        .join(others.hint("shuffle_hash"), F.col("word") == F.col("counted"), "left")
        .select("key", (F.col("times") * log_step[F.col("from_class") * 64 + F.coalesce("class", part("forms", 0))]).alias("value"))
        .groupBy("key").agg(F.sum("value").alias("value"))
        .select("key", F.lit(None).cast("long").alias("doc_id"), F.lit(_PAIR).alias("kind"), "value", F.lit(False).alias("is_word"), F.lit(None).cast("long").alias("c"), F.lit(None).cast("double").alias("moved"))
    )
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("value")))
    zero = F.lit(0.0)
    per = met.unionByName(pairs).groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), of(_COPIES).alias("copies"), of(_TOKENS).alias("n_tokens"),
        (of(_KNOWN) + F.coalesce(F.sum(F.when(F.col("is_word") & F.col("c").isNotNull(), F.col("kind"))), F.lit(0))).alias("n_known"),
        F.coalesce(F.sum(F.when(F.col("is_word"), F.col("kind") * F.log10(F.coalesce("c", F.lit(0)) + 0.5))), zero).alias("worth"), of(_BASE).alias("base"),
        (of(_MODEL) + F.coalesce(of(_PAIR), zero) + F.coalesce(F.sum("moved"), zero)).alias("model"),
    )
    each = lambda c: F.col(c) / F.col("copies")
    return per.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", held_out("doc_id", mod, rest).alias("held_out"), F.round(each("n_tokens")).cast("long").alias("n_tokens"),
        F.round(each("n_known")).cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        ((F.col("base") + F.col("worth")) / F.col("copies")).alias("base_score"), ((F.col("model") + F.col("worth")) / F.col("copies")).alias("score"),
    )
