"""Hard negatives by rotated one-bit codes with deterministic score intervals (operator 11).

An anchor's positives are its best rows of the same label; its hard negatives are rows of
other labels that score nearly as high as a positive. Scores are integer inner products of
quantized vectors (floor(256 x)).

1. Index: every row becomes ``LEVELS`` one-bit codes. A level rotates what is left of the
   vector (signs and Hadamard steps, orthonormal), keeps the sign bits b, stores the
   alignment <b, rest> and passes the residual on. So v = sum of alignment_l * b_l + r,
   with the length of r stored. Every valid row is indexed.
2. An anchor is rotated the same way and cut to ``BITS`` bits a component, held as bit
   planes, so <b_l, anchor> is a sum of popcounts. The error is bounded for certain: the
   planes' rounding by its absolute sum, the residual by Cauchy-Schwarz (|r| |anchor|).
   Each pair thus has an interval that holds its score.
3. Rows whose interval cannot reach the places still open (the best exact scores so far, or the
   lower ends of this block's intervals) go; the surviving ones are integer-scored.
   The result is exact: no candidate is dropped by an estimate.
4. A task keeps the first places of each anchor among its own rows; a window merges the tasks' places.

Anchors are a query set: they come in waves of at most about ``ANCHORS`` rows (a bounded
broadcast), each wave scans the index twice (positives, then negatives) in blocks, and the
rows are never shuffled for it. Work grows with anchors x rows, as the question does; the memory of a task
with the block, and a lost executor costs its tasks only.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component
take no part. An empty vector scores 0 with all; a shorter vector counts as zero in the components it
lacks. Equal rows (id, label and quantized vector) are one row; other rows of one id are
rows of their own, but rows of one id are never each other's partners. Ties go by the smaller
id. Components saturate where a score could leave 64 bits (beyond 2**20 at 64 components).
An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import setup, staged
from notecodes.session import scratch_path

LEVELS, BITS = 4, 5
#: Anchors of a wave, about; they and their positives are all that is broadcast.
ANCHORS = 1 << 15
#: Rows of an index partition, at most about.
PARTITION_ROWS = 1 << 16
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 32
NOTHING = np.iinfo(np.int64).min

_ROWS = "vec_id long, label int, vector binary, code binary, scale binary"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row (a power of two of columns)."""
    x, n, step = x.copy(), x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, level: int) -> np.ndarray:
    """``x`` turned by the level's rotation: two rounds of fixed random signs and a Hadamard step."""
    for turn in range(2):
        sign = 1.0 - 2.0 * (tn.seeds(x.shape[1], 1009 * level + turn) >> np.uint64(40) & np.uint64(1)).astype(float)
        x = hadamard(x * sign)
    return x


@dataclass
class Codes:
    """Of each row: the sign bits of every level, their alignments, and the bound factors."""

    bits: np.ndarray  # [level, row, word]
    align: np.ndarray  # [level, row]
    rest: np.ndarray  # length of what the levels leave
    length: np.ndarray


def codes_of(vectors: np.ndarray) -> Codes:
    rest, dim = vectors.astype(float), vectors.shape[1]
    length = np.sqrt((rest * rest).sum(axis=1))
    bits, align = [], []
    for level in range(LEVELS):
        rest = rotated(rest, level)
        up = rest >= 0
        along = np.abs(rest).sum(axis=1) / np.sqrt(dim)
        rest = rest - np.where(up, 1.0, -1.0) * (along / np.sqrt(dim))[:, None]
        bits.append(np.packbits(up, axis=1).view(np.uint64))
        align.append(along)
    return Codes(np.array(bits), np.array(align), np.sqrt((rest * rest).sum(axis=1)), length)


@dataclass
class Planes:
    """Of each anchor and level: bit planes of its rotated, rounded components, and the bound of the rounding."""

    bits: np.ndarray  # [level, plane, anchor, word]
    least: np.ndarray  # [level, anchor]: value of 0
    step: np.ndarray  # [level, anchor]
    total: np.ndarray  # [level, anchor]: sum of the rounded components
    off: np.ndarray  # [level, anchor]: |<b, rounding>| is at most this
    length: np.ndarray


def planes_of(vectors: np.ndarray) -> Planes:
    x, dim = vectors.astype(float), vectors.shape[1]
    length = np.sqrt((x * x).sum(axis=1))
    bits, least, step, total, off = [], [], [], [], []
    for level in range(LEVELS):
        x = rotated(x, level)
        low = x.min(axis=1, initial=0.0)
        width = np.maximum((x.max(axis=1, initial=0.0) - low) / ((1 << BITS) - 1), 1e-300)
        whole = np.rint((x - low[:, None]) / width[:, None]).astype(np.uint8)
        bits.append(np.array([np.packbits(whole >> j & 1, axis=1).view(np.uint64) for j in range(BITS)]))
        off.append(np.abs(x - low[:, None] - width[:, None] * whole).sum(axis=1) / np.sqrt(dim))
        least.append(low)
        step.append(width)
        total.append(whole.sum(axis=1, dtype=np.int64))
    return Planes(np.array(bits), np.array(least), np.array(step), np.array(total), np.array(off), length)


def intervals(codes: Codes, planes: Planes, rows: slice, anchors: slice) -> tuple[np.ndarray, np.ndarray]:
    """Integer bounds [anchor, row] that hold the inner products of the block for certain."""
    dim = 64 * codes.bits.shape[2]
    guess, error = 0.0, np.outer(planes.length[anchors], codes.rest[rows])
    for level in range(LEVELS):
        own = codes.bits[level, rows]
        ones = np.bitwise_count(own).sum(axis=1, dtype=np.int64)
        both = np.zeros((anchors.stop - anchors.start, len(own)), np.int32)
        for plane in range(BITS):
            theirs = planes.bits[level, plane, anchors]
            for word in range(own.shape[1]):
                both += np.bitwise_count(own[None, :, word] & theirs[:, None, word]).astype(np.int32) << plane
        low, step, total = (x[level, anchors][:, None] for x in (planes.least, planes.step, planes.total))
        dot = (low * (2 * ones - dim) + step * (2 * both - total)) / np.sqrt(dim)
        guess = guess + codes.align[level, rows] * dot
        error = error + planes.off[level, anchors][:, None] * codes.align[level, rows]
    error = error + 1e-9 * (1 + np.outer(planes.length[anchors], codes.length[rows]))  # rounding of these sums
    return np.ceil(guess - error), np.floor(guess + error)


def products(vectors: np.ndarray, queries: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer scores of the pairs (row, anchor), in bounded pieces."""
    out, piece = np.zeros(len(row), np.int64), max(1, (1 << 20) // max(1, vectors.shape[1]))
    for at in range(0, len(row), piece):
        to = slice(at, at + piece)
        out[to] = (vectors[row[to]].astype(np.int64) * queries[anchor[to]]).sum(axis=1)
    return out


def first_places(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, many: int) -> np.ndarray:
    """Positions of each slot's ``many`` best by (score, smaller id)."""
    order = np.lexsort((ids, -score, slot))
    s = slot[order]
    begin = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    place = np.arange(len(s)) - np.repeat(begin, np.diff(np.append(begin, len(s))))
    return order[place < many]


class Places:
    """The ``many`` best (score, id) of each slot among the rows seen, and the score that a newcomer must reach."""

    def __init__(self, slots: int, many: int) -> None:
        self.many, self.floor = many, np.full(slots, NOTHING, np.int64)
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.append(self.slot, slot), np.append(self.score, score), np.append(self.ids, ids)
        keep = first_places(slot, score, ids, self.many)
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]
        full = np.bincount(self.slot, minlength=len(self.floor)) == self.many
        worst = np.full(len(self.floor), np.iinfo(np.int64).max)
        np.minimum.at(worst, self.slot, self.score)
        self.floor[full] = worst[full]


def nth_largest(values: np.ndarray, many: int) -> np.ndarray:
    """Of each row the ``many``-th largest value (-inf if it has fewer)."""
    if values.shape[1] < many:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - many, axis=1)[:, values.shape[1] - many]


def binary_rows(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A binary column of equally long values as a 2-d array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


@dataclass
class Queries:
    """A wave's anchors."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    planes: Planes


def _quantized(dim: int):
    most = int(np.sqrt((1 << 62) / dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column("embedding")
            lengths = np.asarray(got.value_lengths().fill_null(0)).astype(np.int64)
            flat = got.flatten()
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            bad = np.bincount(row, weights=~np.isfinite(values), minlength=batch.num_rows) > 0
            whole = np.zeros((batch.num_rows, dim), np.int32)
            begin = np.cumsum(lengths) - lengths
            fine = np.isfinite(values)
            whole[row[fine], (np.arange(len(values)) - begin[row])[fine]] = np.clip(np.floor(256.0 * values[fine]), -most, most)
            out = pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes() for x in whole], pa.binary())], ["vec_id", "label", "vector"]
            )
            yield out.filter(pa.array(~bad))

    return run


def _coded(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(binary_rows(batch.column("vector"), np.int32, dim))
                bits = np.ascontiguousarray(codes.bits.transpose(1, 0, 2))
                scale = np.column_stack((codes.align.T, codes.rest, codes.length))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([x.tobytes() for x in bits], pa.binary()), pa.array([x.tobytes() for x in scale], pa.binary())],
                    ["vec_id", "label", "vector", "code", "scale"],
                )

    return run


def index(rows: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, vector, code, scale) of every valid row of ``rows`` (vec_id, embedding, label), written once, and the dimension."""
    setup(rows.sparkSession)
    given = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), F.col("embedding").cast("array<double>")).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
    )
    seen = given.agg(F.max(F.size("embedding")).alias("dim"), F.count("*").alias("n")).first()
    dim = max(64, 1 << (max(1, int(seen["dim"] or 0)) - 1).bit_length())
    parts = max(-(-int(seen["n"]) // PARTITION_ROWS), min(2 * rows.sparkSession.sparkContext.defaultParallelism, 1 + int(seen["n"]) // 512))
    whole = given.mapInArrow(_quantized(dim), "vec_id long, label int, vector binary").repartition(parts, "vec_id").dropDuplicates(["vec_id", "label", "vector"])
    return staged(whole.mapInArrow(_coded(dim), _ROWS), "codes"), dim


def _blocks(batches: Iterator[pa.RecordBatch], queries: Queries, dim: int):
    """Blocks of rows x anchors: their rows (ids, labels, vectors), anchors, and intervals."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            vectors = binary_rows(batch.column("vector"), np.int32, dim)
            bits = binary_rows(batch.column("code"), np.uint64, LEVELS * dim // 64).reshape(-1, LEVELS, dim // 64).transpose(1, 0, 2)
            scale = binary_rows(batch.column("scale"), float, LEVELS + 2)
            codes = Codes(bits, scale[:, :LEVELS].T, scale[:, LEVELS], scale[:, LEVELS + 1])
            for first in range(0, len(queries.ids), BLOCK_ANCHORS):
                anchors = slice(first, min(first + BLOCK_ANCHORS, len(queries.ids)))
                yield ids, labels, vectors, anchors, *intervals(codes, queries.planes, slice(0, len(ids)), anchors)


def _placed(places: Places) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(places.slot), pa.array(places.ids), pa.array(places.score)], ["slot", "vec_id", "score"])


def _positives(shared, dim: int, many: int):
    """First places among rows of the anchor's label; a slot is an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        places = Places(len(queries.ids), many)
        for ids, labels, vectors, anchors, low, high in _blocks(batches, queries, dim):
            same = (labels[None, :] == queries.labels[anchors, None]) & (ids[None, :] != queries.ids[anchors, None])
            floor = np.maximum(places.floor[anchors], nth_largest(np.where(same, low, -np.inf), many))
            anchor, row = np.nonzero(same & (high >= floor[:, None]))
            anchor += anchors.start
            places.add(anchor, products(vectors, queries.vectors, row, anchor), ids[row])
        yield _placed(places)

    return run


def lowest(tops: np.ndarray, band: tuple[int, int]) -> np.ndarray:
    """The smallest integers that are at least band[0] / band[1] of ``tops`` (above every score where there is no positive)."""
    whole, part = tops // band[1], tops % band[1]  # in two parts: the product cannot overflow
    return np.where(tops == NOTHING, np.iinfo(np.int64).max, whole * band[0] + -(-(part * band[0]) // band[1]))


def _negatives(shared, dim: int, many: int, band: tuple[int, int]):
    """First places among rows of other labels in the band of a positive's score; a slot is an anchor's positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, tops = shared.value  # tops: [anchor, place] scores of the positives
        per = tops.shape[1]
        bottoms = lowest(tops, band)
        places = Places(tops.size, many)
        for ids, labels, vectors, anchors, low, high in _blocks(batches, queries, dim):
            other = (labels[None, :] != queries.labels[anchors, None]) & (ids[None, :] != queries.ids[anchors, None])
            wanted = np.zeros(other.shape, bool)
            for place in range(per):
                top, bottom = tops[anchors, place][:, None], bottoms[anchors, place][:, None]
                inside = other & (low >= bottom) & (high <= top)
                floor = np.maximum(places.floor[np.arange(anchors.start, anchors.stop) * per + place], nth_largest(np.where(inside, low, -np.inf), many))
                wanted |= other & (high >= np.maximum(bottom, floor[:, None])) & (low <= top)
            anchor, row = np.nonzero(wanted)
            anchor += anchors.start
            score = products(vectors, queries.vectors, row, anchor)
            for place in range(per):
                fits = (score >= bottoms[anchor, place]) & (score <= tops[anchor, place]) & (score >= places.floor[anchor * per + place])
                places.add(anchor[fits] * per + place, score[fits], ids[row[fits]])
        yield _placed(places)

    return run


def _merged(found: DataFrame, many: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= many)


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, band: tuple[int, int] = (80, 100), anchors: int = ANCHORS
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``rows``: (vec_id, embedding, label); ``anchor``: which of them are anchors, over vec_id and label. A negative's
    score is at least band[0] / band[1] of the positive's and at most the positive's.
    """
    spark: SparkSession = rows.sparkSession
    table, dim = index(rows)
    asked = staged(table.where(anchor).select("vec_id", "label", "vector"), "anchors")
    waves = -(-asked.count() // anchors)
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long"
    if not waves:
        return spark.createDataFrame([], schema)
    for wave in range(waves):
        got = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave).toArrow().sort_by([("vec_id", "ascending"), ("label", "ascending"), ("vector", "ascending")])
        if not got.num_rows:
            continue
        got = got.combine_chunks()
        vectors = binary_rows(got.column("vector"), np.int32, dim).astype(np.int64)
        queries = Queries(got.column("vec_id").to_numpy(), got.column("label").to_numpy(), vectors, planes_of(vectors))
        shared = spark.sparkContext.broadcast(queries)
        best = _merged(table.mapInArrow(_positives(shared, dim, positives), "slot long, vec_id long, score long"), positives).toArrow()  # at most ``positives`` an anchor
        slot, place = best.column("slot").to_numpy(), best.column("place").to_numpy() - 1
        tops, ids = np.full((len(queries.ids), positives), NOTHING, np.int64), np.zeros((len(queries.ids), positives), np.int64)
        tops[slot, place], ids[slot, place] = best.column("score").to_numpy(), best.column("vec_id").to_numpy()
        both = spark.sparkContext.broadcast((queries, tops))
        found = _merged(table.mapInArrow(_negatives(both, dim, negatives, band), "slot long, vec_id long, score long"), negatives)
        names = pa.table({
            "at": pa.array(slot * positives + place, pa.int64()), "anchor_id": pa.array(queries.ids[slot]), "positive_id": pa.array(ids[slot, place]),
            "positive_rank": pa.array(place + 1, pa.int32()), "positive_score": pa.array(tops[slot, place]),
        })
        (
            found.join(F.broadcast(spark.createDataFrame(names)), F.col("slot") == F.col("at"))
            .select("anchor_id", "positive_id", "positive_rank", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score"))
            .write.mode("append").parquet(out)
        )
    return spark.read.schema(schema).parquet(out)
