"""Quality classifier on random-indexing word vectors (operator 8).

* A word's *form* is its character shape (case, digits, symbols) with its last
  three bytes, hashed to ``FORMS`` buckets. Every form has a random sparse index vector;
  a form's context vector is the sum of the index vectors of the words up to
  ``REACH`` places away, over all documents. Spark sums the tasks' partial
  tables (FORMS rows a task at most), so the table's size is fixed.
* A document's features pool its words' vectors: mean, spread, the mean
  agreement of neighbouring words' vectors and of their identities, and how
  many different words it has for its length.
* A two-layer numpy network is trained on a bounded sample of labelled rows
  (``TRAIN_ROWS``); a fifth of the sample calibrates its temperature.

Defined cases: null and empty texts have zero features and the network's score
for them. Without labels of both classes every score is the share of good
labels (0.5 without labels). Repeated rows and ids are scored row by row.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import held_out, kept_rows, labelled_sample, scored, setup

FORMS, DIMS, REACH = 1 << 13, 24, 2
TRAIN_ROWS, HIDDEN, EPOCHS = 30_000, 24, 60
#: predicted is 1 from this score on.
GOOD_FROM = 0.3

_SLICE = 1 << 20


def _shape_table() -> np.ndarray:
    """Byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 ASCII symbol, 5 non-ASCII."""
    t = np.zeros(256, np.uint64)
    for b in range(256):
        c = chr(b)
        t[b] = 5 if b >= 0x80 else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if 0x21 <= b <= 0x7E else 0
    return t


_SHAPE = _shape_table()


def index_vectors() -> np.ndarray:
    """Sparse ternary index vectors: four of DIMS entries, two +1 and two -1, from the form's hash."""
    out = np.zeros((FORMS, DIMS), np.int8)
    for j, seed in enumerate(tn.seeds(4, 7)):
        at = (tn.mix64(np.arange(FORMS, dtype=np.uint64) * seed + seed) >> np.uint64(33)) % np.uint64(DIMS)
        out[np.arange(FORMS), at.astype(int)] += 1 if j % 2 == 0 else -1
    return out


def forms_of(data: np.ndarray, words: tn.Words) -> np.ndarray:
    """Form bucket of each word."""
    start, last = words.start, words.end - 1
    back = lambda k: np.where(last - k >= start, data[np.maximum(last - k, 0)], 0).astype(np.uint64)
    kind = _SHAPE[data]
    first = kind[start]
    second = np.where(last > start, kind[np.minimum(start + 1, len(data) - 1)], 0)
    key = back(0) | back(1) << np.uint64(8) | back(2) << np.uint64(16) | first << np.uint64(24) | second << np.uint64(32)
    return (tn.mix64(key + np.uint64(1)) >> np.uint64(64 - 13)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = index_vectors()
    total = np.zeros((DIMS, FORMS))
    for batch in batches:
        for part in tn.slices(batch, "text", _SLICE):
            data, offsets = tn.buffer_of(part.column("text"))
            words = tn.words_of(data, offsets, tn.NON_SPACE)
            if not len(words.hash):
                continue
            form, doc = forms_of(data, words), words.doc
            around = np.zeros((len(form), DIMS), np.int8)
            for d in range(1, REACH + 1):
                same = (doc[d:] == doc[:-d])[:, None]
                around[d:] += index[form[:-d]] * same
                around[:-d] += index[form[d:]] * same
            for j in range(DIMS):
                total[j] += np.bincount(form, weights=around[:, j], minlength=FORMS)
    used = np.flatnonzero(np.abs(total).sum(axis=0))
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(total[j, used].astype(np.int64)) for j in range(DIMS))], ["form", *(f"v{j}" for j in range(DIMS))])


def form_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all forms over all documents (a table of fixed size)."""
    setup(docs.sparkSession)
    names = [f"v{j}" for j in range(DIMS)]
    got = (
        docs.select(F.col("text").cast("string")).mapInArrow(_contexts, "form int, " + ", ".join(f"{n} long" for n in names))
        .groupBy("form").agg(*(F.sum(n).alias(n) for n in names)).toArrow()  # FORMS rows at most
    )
    out = np.zeros((FORMS, DIMS), np.float32)
    if got.num_rows:
        out[got.column("form").to_numpy()] = np.column_stack([got.column(n).to_numpy() for n in names])
    out += index_vectors()  # a form without neighbours keeps its own direction
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's pooled features."""
    n = len(offsets) - 1
    words = tn.words_of(data, offsets, tn.NON_SPACE)
    out = np.zeros((n, 2 * DIMS + 4))
    full = np.flatnonzero(words.counts)
    if not len(full):
        return out
    at, count = words.first[:-1][full], words.counts[full].astype(float)
    v = vectors[forms_of(data, words)]
    mean = np.add.reduceat(v, at, axis=0) / count[:, None]
    square = np.add.reduceat(v * v, at, axis=0) / count[:, None]
    same_text = words.doc[1:] == words.doc[:-1]
    near = np.zeros(len(v))
    near[1:] = (v[1:] * v[:-1]).sum(axis=1) * same_text
    equal = np.zeros(len(v))
    equal[1:] = (words.hash[1:] == words.hash[:-1]) & same_text
    pairs = np.maximum(count - 1, 1)
    order = np.lexsort((words.hash, words.doc))
    h, d = words.hash[order], words.doc[order]
    different = np.bincount(d[np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))], minlength=n)[full]
    out[full] = np.column_stack([
        mean, np.sqrt(np.maximum(square - mean * mean, 0)),
        np.add.reduceat(near, at) / pairs, np.add.reduceat(equal, at) / pairs, np.log(different) / np.log(count + 1), np.log(count),
    ])
    return out


@dataclass
class Network:
    """Standardized features, one tanh layer, one logit, divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows (golden section on its logarithm)."""
    def loss(t: float) -> float:
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    low, high, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Adam on the log loss; every fifth row is held back for the temperature."""
    back = np.arange(len(x)) % 5 == 4
    rng = np.random.default_rng(seed)
    mean, scale = x[~back].mean(axis=0), x[~back].std(axis=0) + 1e-3
    z, t = (x[~back] - mean) / scale, y[~back]
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden), "w2": rng.normal(0, 1 / np.sqrt(hidden), hidden), "b2": np.zeros(1)}
    m, s, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    # small samples get as many steps as large ones
    for _ in range(max(epochs, min(2000, 300_000 // max(1, len(z))))):
        order = rng.permutation(len(z))
        for a in range(0, len(z), 256):
            xb, yb = z[order[a: a + 256]], t[order[a: a + 256]]
            hid = np.tanh(xb @ p["w1"] + p["b1"])
            err = (1 / (1 + np.exp(-np.clip(hid @ p["w2"] + p["b2"], -30, 30))) - yb) / len(xb)
            back_hid = np.outer(err, p["w2"]) * (1 - hid * hid)
            grad = {"w1": xb.T @ back_hid + 1e-5 * p["w1"], "b1": back_hid.sum(axis=0), "w2": hid.T @ err + 1e-5 * p["w2"], "b2": np.array([err.sum()])}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p["w1"], p["b1"], p["w2"], float(p["b2"][0]))
    if back.any():
        net.temperature = max(0.25, calibrated(net.logits(x[back]), y[back]))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    base: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(offsets) - 1, self.base)
        return self.network.probabilities(pooled(self.vectors, data, offsets))


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, train_rows: int = TRAIN_ROWS) -> Model:
    """Form vectors over all documents and a network on the training sample."""
    vectors = form_vectors(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text", _SLICE):
                x = pooled(vectors, *tn.buffer_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    # bounded by the sample
    got = labelled_sample(docs, labels, "quality", mod, rest, train_rows).mapInArrow(run, "doc_id long, label int, x array<double>").toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    y = (got.column("label").to_numpy()[order] > 0).astype(float)
    if len(y) == 0 or y.min() == y.max():
        return Model(vectors, None, float(y.mean()) if len(y) else 0.5)
    x = np.array(got.column("x").to_pylist())[order]
    return Model(vectors, train(x, y), float(y.mean()))


def quality_scores(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    return scored(docs, fit(docs, labels, mod, rest)).select(
        "doc_id", held_out("doc_id", mod, rest).alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    )


def good_only(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0) -> DataFrame:
    """The rows of ``docs`` that are predicted good."""
    return kept_rows(docs, fit(docs, labels, mod, rest), lambda s: s >= GOOD_FROM)
