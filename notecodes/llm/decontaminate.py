"""Benchmark decontamination by winnowing (operator 6).

Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. A
*window* is ``SPAN`` consecutive words of a benchmark item; an item of fewer
words is one window. Every document word inside an occurrence of a window is
hit.

* Items and documents are fingerprinted by winnowing: of every run of
  ``SPAN - GRAM + 1`` successive ``GRAM``-gram hashes the smallest (the
  rightmost of equals) is kept. Two texts that share SPAN words share the
  grams inside them, hence also the kept one: no shared window is missed.
* Fingerprints of documents are matched against those of the benchmark. A
  bitmap of fixed size (2 MB, aggregated by Spark) keeps fingerprints that are
  surely absent inside their task; the rest go on.
* Hits are extended: each window of the document around a kept gram is looked
  up among the item windows, in a join on the window's hash.
* Items of fewer than SPAN words have no such guarantee from GRAM-grams; their
  one window is looked up at every position, for each such item length.

Defined cases: null or wordless texts have no words, are not hit and hit
nothing. Rows are judged by their text, so repeated rows get equal results and
rows of one doc_id with different texts their own. Items with the same id are
one item when listed. Null item_ids match but are not listed and not counted.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import bitmap_of, in_bitmap, setup, staged

SPAN, GRAM = 10, 5

_CHECKED = "doc_id long, text_key long, n_words long, starts array<int>, lengths array<int>, hashes array<long>"


def text_key(text: Column) -> Column:
    """With the id it names a text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _words(batch: pa.RecordBatch) -> tn.Words:
    data, offsets = tn.buffer_of(batch.column("text"))
    return tn.words_of(tn.lower_ascii(data), offsets, tn.ALNUM)


def winnow(words: tn.Words) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the kept GRAM-grams of every text with at least SPAN words."""
    grams = tn.gram_hashes(words.hash, GRAM)
    width = SPAN - GRAM + 1
    doc = words.doc
    n = len(doc) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.flatnonzero(doc[:n] == doc[SPAN - 1:])  # window starts that stay in one text
    best, at = grams[inside].copy(), inside.copy()
    for j in range(1, width):
        value = grams[inside + j]
        less = value <= best
        best[less], at[less] = value[less], inside[less] + j
    at = np.unique(at)
    return at, grams[at]


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text"):
            _, kept = winnow(_words(part))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(kept).view(np.int64))], ["hash"])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch, "text"):
            words = _words(part)
            spans = tn.gram_hashes(words.hash, SPAN)
            ids = part.column("item_id").to_pylist()
            out_id, out_hash, out_len = [], [], []
            for i, (at, to) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                if to - at >= SPAN:
                    h = np.unique(spans[at: to - SPAN + 1])
                elif to > at:
                    h = tn.gram_hashes(words.hash[at:to], to - at)
                else:
                    continue
                out_id += [ids[i]] * len(h)
                out_hash.append(h)
                out_len += [min(SPAN, to - at)] * len(h)
            flat = np.concatenate(out_hash).view(np.int64) if out_hash else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out_len, pa.int32()), pa.array(flat)], ["item_id", "length", "hash"])


def _candidates(grams: np.ndarray, short: dict[int, np.ndarray]):
    """Per document: its word count and the windows whose hash may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "text"):
                words = _words(part)
                doc, total = words.doc, len(words.hash)
                at, kept = winnow(words)
                at = at[in_bitmap(grams, kept)]
                # every window of SPAN words around a kept gram that stays in its text
                around = np.unique((at[:, None] - np.arange(SPAN - GRAM + 1)).reshape(-1))
                around = around[(around >= 0) & (around + SPAN <= total)]
                around = around[doc[around] == doc[around + SPAN - 1]]
                starts, sizes = [around], [np.full(len(around), SPAN)]
                spans = np.zeros(len(around), np.uint64)
                for j, c in enumerate(tn.seeds(SPAN, 17)):
                    spans += words.hash[around + j] * c
                hashes = [tn.mix64(spans + np.uint64(SPAN * int(tn._MIX1) % (1 << 64)))]
                for m, bitmap in short.items():
                    h = tn.gram_hashes(words.hash, m)
                    i = np.flatnonzero(in_bitmap(bitmap, h))
                    i = i[doc[i] == doc[i + m - 1]]
                    starts.append(i), sizes.append(np.full(len(i), m)), hashes.append(h[i])
                s, m, h = np.concatenate(starts), np.concatenate(sizes), np.concatenate(hashes)
                order = np.argsort(s, kind="stable")
                s, m, h = s[order], m[order], h[order]
                owner = doc[s] if len(s) else s
                lengths = np.bincount(owner, minlength=part.num_rows)
                local = s - words.first[owner] if len(s) else s
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(words.counts, pa.int64()),
                     tn.list_array(local.astype(np.int32), lengths, pa.int32()), tn.list_array(m.astype(np.int32), lengths, pa.int32()),
                     tn.list_array(h.view(np.int64), lengths, pa.int64())],
                    ["doc_id", "text_key", "n_words", "starts", "lengths", "hashes"],
                )

    return run


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, length, hash of every window of ``items`` (item_id, text)."""
    setup(items.sparkSession)
    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_item_windows, "item_id long, length int, hash long")


def hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: doc_id, text_key, n_words per row; spans: doc_id, text_key, start, length, hash of the item windows that occur;
    windows: item_id, length, hash)."""
    setup(docs.sparkSession)
    text = items.select(F.col("text").cast("string"))
    windows = staged(item_windows(items), "windows")
    grams = bitmap_of(text.mapInArrow(_item_grams, "hash long"), "hash")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect() if r["length"] < SPAN)  # at most SPAN - 1
    short = {m: bitmap_of(windows.where(F.col("length") == m).select("hash"), "hash") for m in lengths}
    checked = staged(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(F.col("text")).alias("text_key"))
        .mapInArrow(_candidates(grams, short), _CHECKED),
        "checked",
    )
    known = windows.select("hash", "length").distinct()
    found = (
        checked.where(F.size("starts") > 0)
        .select("doc_id", "text_key", F.explode(F.arrays_zip("starts", "lengths", "hashes")).alias("w"))
        .select("doc_id", "text_key", F.col("w.starts").alias("start"), F.col("w.lengths").alias("length"), F.col("w.hashes").alias("hash"))
        .distinct()
        .join(known, ["hash", "length"], "left_semi")
    )
    return checked.select("doc_id", "text_key", "n_words"), staged(found, "found"), windows


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as strings), spans (hit windows, in order), contaminated; one row per row of ``docs``."""
    words, found, windows = hits(docs, items)
    # merge the sorted spans of a text: a span adds the words beyond all before it
    merged = F.aggregate(
        "runs",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["start"] + r["length"] - F.greatest(acc["to"], r["start"]))).alias("n"),
            F.greatest(acc["to"], r["start"] + r["length"]).alias("to"),
        ),
    )
    per_text = (
        found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("runs"))
        .select("doc_id", "text_key", "runs", merged["n"].cast("long").alias("n_hit"))
    )
    listed = (
        found.select("doc_id", "text_key", "hash", "length").distinct()
        .join(windows.where("item_id IS NOT NULL"), ["hash", "length"])
        .groupBy("doc_id", "text_key").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )
    both = (
        per_text.join(listed, on=[per_text["doc_id"].eqNullSafe(listed["doc_id"]), per_text["text_key"] == listed["text_key"]], how="left")
        .select(per_text["doc_id"].alias("d"), per_text["text_key"].alias("k"), "n_hit", "runs", F.sort_array(F.coalesce("items", F.array().cast("array<string>"))).alias("items"))
    )
    return (
        words.join(both, on=[words["doc_id"].eqNullSafe(both["d"]), words["text_key"] == both["k"]], how="left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce(F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"))), F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text no window of ``items`` occurs in."""
    _, found, _ = hits(docs, items)
    hit = staged(found.select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct(), "hit")
    same = docs["doc_id"].cast("long").eqNullSafe(hit["_hit_id"]) & (text_key(docs["text"]) == hit["_hit_key"])
    return docs.join(hit, same, "left_anti")
