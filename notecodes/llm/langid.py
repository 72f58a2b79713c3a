"""Language identification by mixture inference (operator 3).

* Per language, the probabilities of byte trigrams inside words (with word
  edges) are learned from all training documents; trigrams are hashed to
  ``GRAMS`` values, so a language's table has a fixed size.
* A document's words come from a mixture of languages: expectation-maximisation
  estimates the proportions from the words' trigram likelihoods.
* The language set is chosen by penalised likelihood: starting with the likeliest
  language, each step adds the one whose words gain most from it, as long as it raises the
  log likelihood by more than ``PENALTY`` times the logarithm of the word count.
  The largest proportion names the language and is the score.

All steps run on whole slices with numpy. Defined cases: null text and text
without a letter are ``und`` with score 0; letters without any learned language
are ``und`` too. Texts with letters outside words that the model knows get the
likeliest language. Rows with a null or empty lang are not learned from. Repeated rows are
predicted row by row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import held_out, setup

GRAMS, ROUNDS = 1 << 15, 8
PENALTY, SMOOTH = 2.0, 0.5

_SLICE = 1 << 20
#: Bytes of letters: a-z and everything outside ASCII.
_LETTER = np.array([b >= 0x80 or 0x61 <= b <= 0x7A for b in range(256)])


def word_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram buckets, first gram of each word, first word of each text) of lower-cased texts.

    A word's grams are the byte triples of the word between two edge marks.
    """
    data, offsets = tn.buffer_of(pc.utf8_lower(texts.fill_null("")))
    start, end = tn.word_bounds(data, offsets, _LETTER)
    first_word = np.searchsorted(start, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), first_word
    size = end - start  # triples of a word of n bytes and its two edges
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.repeat(start - first, size) + np.arange(int(size.sum()))  # the middle byte of each triple
    wide = np.concatenate((data, np.zeros(1, np.uint8))).astype(np.uint64)
    left, right = wide[at - 1], wide[np.minimum(at + 1, len(data))]
    left[first] = 1
    right[first + size - 1] = 2
    key = left | wide[at] << np.uint64(8) | right << np.uint64(16)
    return (tn.mix64(key + np.uint64(1)) >> np.uint64(64 - 15)).astype(np.int64), first, first_word


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in tn.slices(batch, "text", _SLICE):
            grams, first, words = word_grams(part.column("text"))
            bounds = np.append(first, len(grams))[words]
            langs = part.column("lang").to_pylist()
            for lang in set(langs):
                rows = np.array([x == lang for x in langs])
                pick = np.repeat(rows, np.diff(bounds))
                got = np.bincount(grams[pick], minlength=GRAMS)
                total[lang] = total[lang] + got if lang in total else got
    for lang, counts in total.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["lang", "gram", "n"]
        )


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray  # GRAMS x languages

    def infer(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(predicted languages, scores, proportions: texts x languages) of a slice."""
        n, many = len(texts), len(self.langs)
        share = np.zeros((n, many))
        grams, first, words = word_grams(texts)
        full = np.flatnonzero(np.diff(words))
        if many and len(full):
            like = np.add.reduceat(self.log_p[grams], first, axis=0)
            top = like.max(axis=1, keepdims=True)
            like = np.exp(np.maximum(like - top, -60.0))
            share[full] = mixtures(like, words[:-1][full], np.diff(words)[full])
        best = share.argmax(axis=1) if many else np.zeros(n, int)
        score = share[np.arange(n), best] if many else np.zeros(n)
        names = []
        letters = has_letter(texts)
        for i in range(n):
            names.append(self.langs[best[i]] if letters[i] and many else "und")
        score = np.where(letters & (many > 0), np.maximum(score, 1.0 / max(1, many)), 0.0)
        return names, score, share


def has_letter(texts: pa.Array) -> np.ndarray:
    texts = texts.fill_null("")
    out = np.asarray(pc.match_substring_regex(texts, "[A-Za-z]"))
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of the texts' words one text after the other, first word of each text in them, word counts)."""
    at = np.cumsum(count) - count
    return np.repeat(first - at, count) + np.arange(int(count.sum())), at, count


def em(like: np.ndarray, first: np.ndarray, count: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ``ROUNDS`` rounds from ``share`` (languages of share 0 stay out), and log likelihoods."""
    owner = np.repeat(np.arange(len(first)), count)
    for _ in range(ROUNDS):
        r = like * share[owner]
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(r, first, axis=0) / count[:, None]
    mix = (like * share[owner]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(mix, 1e-300)), first)


def mixtures(like: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) by EM on the languages that penalised likelihood selects.

    ``like``: words x languages, each word's largest is 1; the words of text i are
    ``first[i]`` and the ``count[i] - 1`` after it.
    """
    texts, many = len(first), like.shape[1]
    penalty = PENALTY * np.log(count + 1.0)

    # of one language: the likeliest as a whole
    alone = np.add.reduceat(np.log(np.maximum(like, 1e-26)), first, axis=0)
    best = np.zeros((texts, many))
    best[np.arange(texts), alone.argmax(axis=1)] = 1.0
    value = alone.max(axis=1)
    live = np.arange(texts)  # texts whose last language was worth its penalty
    for k in range(2, many + 1):
        rows, at, size = spans(first[live], count[live])
        part, share, n = like[rows], best[live], len(live)
        now = (part * share[np.repeat(np.arange(n), size)]).sum(axis=1, keepdims=True)
        # the likelihood with a k-th of each further language in the mixture
        gain = np.add.reduceat(np.log(np.maximum(now * (1 - 1 / k) + part / k, 1e-26)), at, axis=0)
        allowed = share > 0
        allowed[np.arange(n), np.where(allowed, -np.inf, gain).argmax(axis=1)] = True
        got, loglik = em(part, at, size, np.where(allowed, 1.0 / k, 0.0))
        loglik -= (k - 1) * penalty[live]
        better = loglik > value[live]
        live = live[better]
        if not len(live):
            break
        best[live], value[live] = got[better], loglik[better]
    return best


def learn(docs: DataFrame, mod: int = 4, rest: int = 2) -> Model:
    """Trigram tables of all training documents, one per lang value."""
    setup(docs.sparkSession)
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    train = train.where(~held_out("doc_id", mod, rest) & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull()).select("text", "lang")
    # GRAMS rows a language at most
    got = train.mapInArrow(_gram_counts, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = got.column("lang").to_pylist()
    langs = sorted(set(names))
    place = {x: i for i, x in enumerate(langs)}
    counts = np.full((GRAMS, len(langs)), SMOOTH)
    if names:
        counts[got.column("gram").to_numpy(), [place[x] for x in names]] += got.column("n").to_numpy()
    return Model(langs, np.log(counts / counts.sum(axis=0, keepdims=True)) if langs else counts)


def languages(docs: DataFrame, mod: int = 4, rest: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, mixture (language -> proportion) of every row of ``docs`` (doc_id, text, lang)."""
    model = learn(docs, mod, rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                names, score, share = model.infer(part.column("text"))
                mixture = [[(model.langs[j], float(row[j])) for j in np.flatnonzero(row > 0.005)] for row in share]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, pa.map_(pa.string(), pa.float64()))],
                    ["doc_id", "lang_pred", "score", "mixture"],
                )

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, mixture map<string,double>"
    )
    return found.select("doc_id", held_out("doc_id", mod, rest).alias("held_out"), "lang_pred", "score", "mixture")
