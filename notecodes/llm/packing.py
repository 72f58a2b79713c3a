"""Best-fit packing planned over the length histogram (operator 7).

Texts are tokenized to ids (an end id closes each document), long documents are
cut into full pieces behind one shorter first piece, and all pieces are packed
into sequences of at most ``SEQUENCE`` ids.

* The plan is best-fit decreasing over *counts*: the histogram has at most
  SEQUENCE rows whatever the corpus, so it is planned on the driver. A group of
  equal bins takes as many pieces of a length as fit before the next group, the
  same bins that piece-by-piece best fit decreasing would pick.
* A plan row gives the ranks [first, last) of a length consecutive sequences at
  one offset. Pieces get their rank within their length from salted counts (no
  length is numbered in one task) and take their slot in a join on length and
  rank block.
* Tokenizing runs in Arrow batches. A pretoken never holds white space behind
  other characters, so a text is cut before each such white space and equal
  chunks are encoded once per task (a bounded cache); ids are assembled by
  numpy. Texts that contain an added token's string are encoded whole.

Defined cases: null texts are empty and become the end id alone. Repeated rows
are packed once each. A null doc_id is packed with a null doc_id. Extra columns
are not read, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import setup, staged

SEQUENCE, END_ID = 2048, 0
#: Distinct chunks that a task keeps encoded, about.
CACHE_CHUNKS = 300_000
#: Pieces numbered together within a length, and ranks joined together.
RANK_BUCKET, RANK_BLOCK = 50_000, 4096

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SPACE = ~tn.NON_SPACE


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Cut points inside and at the starts of texts: ASCII white space behind a
    character that surely is none. Behind control bytes, and behind characters
    that may be Unicode white space, texts are left whole."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        before = data[:-1]
        cut[1:n] = _SPACE[data[1:]] & (before > 0x20) & (before != 0x7F)
        two, three = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        two[2:], three[3:] = data[:-2], data[:-3]
        unsure = ((two == 0xC2) & np.concatenate(([False], (before == 0x85) | (before == 0xA0)))) | ((three >= 0xE1) & (three <= 0xE3))
        cut[:n] &= ~unsure
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


def chunk_coder(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    """Encodes short chunks. A plain byte-level BPE file is also given to tiktoken
    (its ids are its merge ranks), which takes a fifth of the time for the same
    ids; any other file is encoded by its own library."""
    import json

    spec = json.loads(tokenizer.to_str())
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        and before.get("use_regex", True) and not spec.get("normalizer") and not model.get("dropout")
        and not model.get("ignore_merges") and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
    )
    if plain:
        # the printable stand-ins of byte-level BPE: printable Latin-1 characters are themselves, the others follow from U+0100
        kept = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
        stand_in = {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
        added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(stand_in[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        # merges must rank as their results' ids do, or the two libraries could differ
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if all(x < y for x, y in zip(merged, merged[1:])):
            import public_tokenizers
            import tiktoken

            fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda texts: [fast.encode_ordinary(t) for t in texts]
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class ChunkEncoder:
    """Ids of texts by one tokenizer file, with equal chunks encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks = chunk_coder(self.tokenizer)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.clear()

    def clear(self) -> None:
        # hashes of the known chunks in ascending order, and the slot of each
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first = np.zeros(1 << 14, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """``hashes`` ascend, and none of them is known."""
        ids = self.chunks(texts)
        lengths = np.array([len(i) for i in ids], np.int64)
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(lengths.sum()))
        at, n = len(self.known), len(hashes)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + n + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.flat[self.used: self.used + len(flat)] = flat
        self.first[at + 1: at + n + 1] = self.used + np.cumsum(lengths)
        self.used += len(flat)
        place = np.searchsorted(self.known, hashes)
        self.known, self.slot = np.insert(self.known, place, hashes), np.insert(self.slot, place, np.arange(at, at + n))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, first id of each text) of the slice's texts, without end ids."""
        if len(self.known) > CACHE_CHUNKS:
            self.clear()
        starts = chunk_starts(data, offsets)
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        unique, example, which = np.unique(tn.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        slot = np.full(len(unique), -1)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, unique), len(self.known) - 1)
            slot = np.where(self.known[place] == unique, self.slot[place], -1)
        new = np.flatnonzero(slot < 0)
        if len(new):
            raw = data.tobytes()
            a, b = starts[example[new]].tolist(), ends[example[new]].tolist()
            slot[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(unique[new], [raw[x:y].decode("utf-8", "replace") for x, y in zip(a, b)])
        slot = slot[which]
        begin, size = self.first[slot], self.first[slot + 1] - self.first[slot]
        to = np.cumsum(size)
        flat = self.flat[np.repeat(begin - (to - size), size) + np.arange(to[-1] if len(to) else 0)]
        bound = np.concatenate(([0], to))[np.searchsorted(starts, offsets)]
        return flat, bound

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Each text's ids."""
        flat, bound = self.encode(data, offsets)
        raw = data.tobytes()
        rare = any(a in raw for a in self.added)
        for i in range(len(offsets) - 1):
            if rare and any(a in (text := raw[offsets[i]: offsets[i + 1]]) for a in self.added):
                yield np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
            else:
                yield flat[bound[i]: bound[i + 1]]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def tokenizer_path() -> str:
    """The default tokenizer file (asked on the executor, where the file is read)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(path: str | None, sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from notecodes.llm import packing  # the worker's module keeps the encoder between tasks

        coder = packing.encoder(path or tokenizer_path())
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            for part in tn.slices(batch, "text"):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(coder.texts(*tn.buffer_of(part.column("text")))):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    cuts = [0, *range(len(ids) % sequence or sequence, len(ids), sequence), len(ids)]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i), piece.append(p), start.append(a), length.append(b - a), crc.append(zlib.crc32(ids[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        coder.clear()  # the worker lives on and may run other stages
        tn.trim()

    return run


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of ``docs`` (doc_id, text)."""
    setup(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_pieces(path, sequence), _PIECES)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, last rank, first sequence, offset).

    ``rooms[r]`` holds the groups (first sequence, bins) that have r ids of room.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    rows: list[tuple[int, int, int, int, int]] = []
    used = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        fits = sorted(r for r in rooms if r >= length)
        while left:
            if fits:
                room = fits[0]
                first, bins = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    fits.pop(0)
            else:
                room, first = sequence, used
                bins = -(-left // (sequence // length))
                used += bins
            each = room // length  # a bin is filled before the next one is touched
            full, over = min(bins, left // each), 0
            if full < bins:
                over = left - full * each
            done = full * each + over
            for start, count, layers in ((first, full, each), (first + full, 1, over)):
                if count and layers:
                    for j in range(layers):
                        rows.append((length, rank, rank + count, start, sequence - room + j * length))
                        rank += count
                    if room > layers * length:
                        rooms.setdefault(room - layers * length, []).append((start, count))
            touched = full + bool(over)
            if touched < bins:
                rooms.setdefault(room, []).append((first + touched, bins - touched))
            left -= done
    return rows


def ranked(found: DataFrame) -> DataFrame:
    """``found`` with its rank within its length: bucket counts give each bucket its first rank."""
    buckets = found.groupBy().count().first()[0] // RANK_BUCKET + 1
    salted = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = salted.groupBy("length", "bucket").agg(F.count("*").alias("c"))
    begin = counts.select(
        "length", "bucket",
        (F.sum("c").over(Window.partitionBy("length").orderBy("bucket")) - F.col("c")).alias("begin"),
    )
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("own", F.row_number().over(own)).join(begin, ["length", "bucket"])
        .withColumn("rank", F.col("begin") + F.col("own") - 1).drop("bucket", "begin", "own")
    )


def packed(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    spark = docs.sparkSession
    found = staged(pieces(docs, path, sequence), "pieces")
    histogram = {r["length"]: r["c"] for r in found.groupBy("length").agg(F.count("*").alias("c")).collect()}  # at most `sequence` rows
    slots = (
        spark.createDataFrame(plan(histogram, sequence), "plan_length long, first long, last long, first_sequence long, offset long")
        .withColumn("block", F.explode(F.sequence(F.expr(f"first div {RANK_BLOCK}"), F.expr(f"(last - 1) div {RANK_BLOCK}"))))
    )
    taken = ranked(found).withColumn("rank_block", F.expr(f"rank div {RANK_BLOCK}"))
    return taken.join(
        slots,
        (F.col("length") == F.col("plan_length")) & (F.col("rank_block") == F.col("block"))
        & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )
