"""MinHash near-duplicate groups by a signature-coordinate inverted join (operator 10).

Documents are linked when the Jaccard similarity of their word 5-shingle sets
is at least 0.75; groups are the connected components of those links.

1. Every text becomes its shingle set and a MinHash signature of ``K``
   coordinates (numpy, in Arrow batches). Equal sets collapse to one *node*
   (its smallest doc_id), so exact copies never meet again.
2. A node is posted under its coordinate values. A pair is a candidate when at
   least ``T`` of the K coordinates collide; a linked pair misses that with
   probability P[Bin(K, 0.75) < T] < 1e-6. By the pigeonhole principle a pair with T
   collisions shares one of any K - T + 1 coordinates, so each node skips its
   T - 1 longest posting lists (prefix and skip merging: the long lists are
   never merged, their collisions are counted from the signatures instead).
3. First every posting list links its members to two hubs (its first node and its
   smallest set), the links are confirmed on the full sets, and components are formed. Large groups end
   here with a few links a member instead of all pairs.
4. Only list members of *different* components still need a comparison. In
   lists of at most ``LONG`` nodes, members outside the list's largest component
   meet the others, with the same count threshold and confirmation.
5. Longer lists with several components (a passage that many texts share) are
   not merged. Their members go an exact way instead: a prefix join on the
   shingles themselves, rarest first. A linked pair shares one of the first
   n - ceil(0.75 n) + 1 shingles of either set. Where that is a common shingle
   (a list of more than LONG nodes), the pair shares common shingles only, so
   its similarity is at most m / (na + nb - m), m the smaller number of common shingles of the two:
   only pairs with 3 (na + nb) <= 7 m meet there. A pair whose rarest common
   coordinate has a long list has both members in this way, so no pair is lost.

Nothing is capped or sampled.
All steps between shuffles run in bounded slices; intermediate tables are
written to the shared folder, so a lost executor costs its tasks only.

Defined cases: null or wordless text has an empty set, is its own component
and is kept. Rows that share a doc_id are one document: their texts are linked
through it. A null doc_id has a null component_id and is kept. Extra columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import bitmap_of, in_bitmap, setup, staged

K, T, WORDS = 96, 50, 5
SIMILARITY = (75, 100)
#: Posting lists of at least this share of the nodes are ordered by length; at most K / HOT_SHARE lists are that long.
HOT_SHARE = 1 / 4096
#: Posting lists of more nodes that are still in several components are replaced by the exact way.
LONG = 64
#: Narrow rows that a signature, or a pair with a set, counts for in the number of files.
SET_ROWS = 100

_SIGNED = "doc_id long, n_shingles long, key1 long, key2 long, sig array<long>, code binary"


def signature(shingles: np.ndarray, mult: np.ndarray, flip: np.ndarray) -> np.ndarray:
    """MinHash coordinates of one non-empty set (blocks bound the memory of long texts)."""
    best = np.full(len(mult), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        block = (shingles[at: at + 1024, None] ^ flip) * mult
        np.minimum(best, block.min(axis=0), out=best)
    return best


def document_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    data, offsets = tn.buffer_of(batch.column("text"))
    words = tn.words_of(tn.lower_ascii(data), offsets, tn.NON_SPACE)
    return words.counts, tn.shingle_sets(words, WORDS)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mult, flip = tn.seeds(K, 101), tn.seeds(K, 202)
    for batch in batches:
        for part in tn.slices(batch, "text"):
            _, sets = document_sets(part)
            keys, sigs = np.zeros((2, len(sets)), np.uint64), []
            for i, s in enumerate(sets):
                if len(s):
                    keys[0, i] = tn.mix64(s * tn._MIX1).sum(dtype=np.uint64)
                    keys[1, i] = tn.mix64(s ^ tn._MIX2).sum(dtype=np.uint64)
                    sigs.append(signature(s, mult, flip))
            lengths = np.array([K if len(s) else 0 for s in sets])
            flat = np.concatenate(sigs).view(np.int64) if sigs else np.zeros(0, np.int64)
            codes, at = (flat & 255).astype(np.uint8).tobytes(), np.cumsum(lengths).tolist()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[0].view(np.int64)),
                 pa.array(keys[1].view(np.int64)), tn.list_array(flat, lengths, pa.int64()),
                 pa.array([codes[to - n: to] for to, n in zip(at, lengths.tolist())], pa.binary())],
                ["doc_id", "n_shingles", "key1", "key2", "sig", "code"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit key, its signature and the low byte of each coordinate (empty for an empty set)."""
    setup(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signed, _SIGNED)


def _prefixes(hot_keys: np.ndarray, hot_counts: np.ndarray):
    """Each node's K - T + 1 shortest posting lists, as (key, node, n) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = K - T + 1
        for batch in batches:
            sig = batch.column("sig").flatten().to_numpy().reshape(-1, K)
            length = np.zeros(sig.shape, np.int64)
            if len(hot_keys):
                at = np.minimum(np.searchsorted(hot_keys, sig), len(hot_keys) - 1)
                length = np.where(hot_keys[at] == sig, hot_counts[at], 0)
            pick = np.argsort(length, axis=1, kind="stable")[:, :keep]
            keys = np.take_along_axis(sig, pick, axis=1).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(batch.column("node").to_numpy(), keep)),
                 pa.array(np.repeat(batch.column("n").to_numpy(), keep))],
                ["key", "node", "n"],
            )

    return run


def postings(nodes: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """The posting lists that each node does not skip."""
    total = nodes.count()
    least = max(16, int(total * hot_share))
    hot = (
        nodes.select(F.explode("sig").alias("key")).groupBy("key").agg(F.count("*").alias("c"))
        .where(F.col("c") >= least).toArrow()  # at most K * total / least rows
    )
    keys, counts = hot.column("key").to_numpy(), hot.column("c").to_numpy()
    order = np.argsort(keys)
    return nodes.select("node", "n", "sig").mapInArrow(_prefixes(keys[order], counts[order]), "key long, node long, n long")


def _enough_collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, K) for c in ("ca", "cb"))
            ok = (left == right).sum(axis=1) >= T
            yield batch.select(["a", "b"]).filter(pa.array(ok))


def colliding(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with at least T equal coordinates. Coordinates are compared by
    their low byte (``code``): the count can only be too high, so no pair is lost."""
    return (
        pairs.join(nodes.select(F.col("node").alias("a"), F.col("code").alias("ca")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("code").alias("cb")), "b")
        .select("a", "b", "ca", "cb").mapInArrow(_enough_collisions, "a long, b long")
    )


def _wanted_sets(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            known = np.asarray(ids.is_valid())
            batch = batch.filter(pa.array(known & in_bitmap(bitmap, tn.mix64(ids.fill_null(0).to_numpy().view(np.uint64)))))
            for part in tn.slices(batch, "text"):
                _, sets = document_sets(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), tn.list_array(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64())],
                    ["node", "shingles"],
                )

    return run


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(tn.mix64(batch.column("id").to_numpy().view(np.uint64)).view(np.int64))], ["h"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least, whole = SIMILARITY
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(whole * both >= least * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def wanted_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the texts of ``ids`` (id), and of few others: a bitmap of the ids
    (fixed size) keeps the other texts out before they are hashed."""
    bitmap = bitmap_of(ids.mapInArrow(_mixed, "h long"), "h")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_wanted_sets(bitmap), "node long, shingles array<long>")


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity.

    The sets are always shuffled to their pairs: behind a broadcast of few pairs, one task would hold
    the Python worker that makes the sets and the one that compares them at the same time.
    """
    sets = wanted_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs).hint("merge")
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .select("a", "b", "sa", "sb").mapInArrow(_confirmed, "a long, b long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) reaches.

    Minimum labels travel along edges and labels are followed one step further
    each round (pointer jumping), so rounds grow with the logarithm of a chain's
    length. Each round is one written table.
    """
    rows = 2 * edges.count()  # of directed edges, and so of nodes, at most
    both = staged(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges", rows)
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels", rows)
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("near")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        )
        low = labels.join(near, "node").select("node", F.least("comp", "near").alias("low"), "comp")
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        step = staged(
            low.join(jump, "low", "left")
            .select("node", F.least("low", F.coalesce("far", "low")).alias("comp"), (F.least("low", F.coalesce("far", "low")) < F.col("comp")).alias("moved")),
            "labels", rows,
        )
        labels = step.select("node", "comp")
        if step.where("moved").isEmpty():
            return labels


def across(lists: DataFrame) -> DataFrame:
    """Distinct pairs (a > b) of list members (key, node, n, comp, common) of different components
    whose sizes allow a link (3 (na + nb) <= 7 common: see step 5). A list's largest component is met by the others but not by itself."""
    largest = (
        lists.groupBy("key", "comp").agg(F.count("*").alias("c"))
        .groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    )
    marked = lists.join(largest, "key")
    small = marked.where("comp <> main").select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("common").alias("ma"))
    other = marked.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("common").alias("mb"), (F.col("comp") == F.col("main")).alias("is_main"))
    least, whole = SIMILARITY
    return (
        small.join(other, "key")
        .where((F.col("ca") != F.col("cb")) & (F.col("is_main") | (F.col("a") < F.col("b")))
               & (F.least("na", "nb") * whole >= F.greatest("na", "nb") * least)
               & (3 * (F.col("na") + F.col("nb")) <= 7 * F.least("ma", "mb").cast("long")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def rare_shingles(crowded: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, node, n, comp, common): each node's first n - ceil(0.75 n) + 1 shingles, rarest
    among ``crowded`` first, as far as they are in several components.

    Shingles of one node alone come first in that order and need no list, so only
    the shared ones are ordered.
    """
    least, whole = SIMILARITY
    rows = crowded.agg(F.sum("n")).first()[0] or 0  # of shingles
    posted = staged(
        crowded.join(wanted_sets(crowded.select(F.col("node").alias("id")), docs), "node")
        .select("node", "n", "comp", F.explode("shingles").alias("key")),
        "crowded_sets", rows,
    )
    shared = posted.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        posted.join(shared, "key").groupBy("node", "n", "comp")
        .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("keys"))  # at most the node's own shingles
    )
    common = F.size(F.filter("keys", lambda k: k["df"] > LONG))
    # the prefix less the shingles that no other node has
    room = F.col("n") - F.ceil(F.col("n") * least / F.lit(float(whole))) + 1 - (F.col("n") - F.size("keys"))
    lists = (
        ordered.select("node", "n", "comp", common.alias("common"), F.explode(F.slice("keys", F.lit(1), F.greatest(room, F.lit(0)).cast("int"))).alias("k"))
        .select(F.col("k.key").alias("key"), (F.col("k.df") > LONG).alias("long"), "node", "n", "comp", "common")
    )
    # in long lists: members that some set of the list is small enough for
    small = lists.groupBy("key").agg(F.min("n").alias("least_n"))
    lists = lists.join(small, "key").where("NOT long OR 3 * (n + least_n) <= 7 * common").drop("least_n")
    mixed = lists.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    return staged(lists.join(mixed, "key").withColumn("common", F.expr("CASE WHEN long THEN common ELSE 2147483647 END")).drop("long"), "rare", rows)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    signed = staged(signatures(docs), "signed")
    rows = signed.count()
    classes = staged(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key1", "key2")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("code").alias("code")),
        "classes", SET_ROWS * rows,
    )
    nodes = classes.select("node", "n", "sig", "code")
    posts = (K - T + 1) * nodes.count()
    lists = postings(nodes)
    hubs = lists.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.min_by("node", F.struct("n", "node")).alias("least")).where("hub < last").drop("last")
    shared = staged(lists.join(hubs, "key").select("key", "hub", "least", "node", "n"), "shared", posts)

    spokes = shared.select(F.explode(F.array("hub", "least")).alias("to"), "node").where("node <> to")
    star = staged(colliding(spokes.select(F.greatest("node", "to").alias("a"), F.least("node", "to").alias("b")).distinct(), nodes), "star", posts)
    links = staged(confirmed(star, docs), "links", SET_ROWS * star.count())
    found = components(links)

    placed = shared.join(found, "node", "left").select("key", "node", "n", F.coalesce("comp", "node").alias("comp"))
    lengths = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("length")).where("x < y").select("key", "length")
    open_lists = staged(placed.join(lengths, "key"), "open", posts)
    rest = staged(
        colliding(across(open_lists.where(F.col("length") <= LONG).select("key", "node", "n", "comp", F.lit(2147483647).alias("common"))).join(star, ["a", "b"], "left_anti"), nodes), "rest", posts
    )
    crowded = staged(open_lists.where(F.col("length") > LONG).select("node", "n", "comp").distinct(), "crowded", rows)
    if not crowded.isEmpty():
        met = across(rare_shingles(crowded, docs)).join(star, ["a", "b"], "left_anti").join(rest, ["a", "b"], "left_anti")
        rest = rest.union(staged(colliding(met, nodes), "met"))
    more = staged(confirmed(rest, docs), "more", SET_ROWS * rest.count())
    if not more.isEmpty():
        found = components(links.union(more))

    # every row of a document's id shares its component, also when its texts differ
    texts = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "key1", "key2").join(classes.select("key1", "key2", "node"), ["key1", "key2"])
    own = staged(texts.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last")), "own", rows)
    split = own.where("node < last").select("doc_id", F.col("node").alias("b"))
    if not split.isEmpty():
        through = texts.join(split, "doc_id").select(F.col("node").alias("a"), "b").where("a <> b")
        found = components(links.union(more).union(through))
    own = own.join(found, "node", "left").select(F.col("doc_id").alias("id"), F.coalesce("comp", "node").alias("comp"))
    component = F.coalesce("comp", "doc_id")
    return (
        signed.join(own, signed["doc_id"] == own["id"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    )


def group_heads(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their group: one row each.

    The ids that go are joined by id. Only when an id is repeated are its rows counted
    off (by text); rows without an id stay.
    """
    found = staged(near_duplicates(docs).select("doc_id", "kept"), "found")
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_gone_id")).distinct()
    heads = docs.join(gone, docs["doc_id"].cast("long") == gone["_gone_id"], "left_anti")
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_many_id")).count().where("count > 1").select("_many_id")
    if repeated.isEmpty():
        return heads
    many = heads.join(repeated, heads["doc_id"].cast("long") == repeated["_many_id"], "left_semi")
    first = Window.partitionBy(many["doc_id"]).orderBy(many["text"])
    once = many.withColumn("_place_in_id", F.row_number().over(first)).where("_place_in_id = 1").drop("_place_in_id")
    return heads.join(repeated, heads["doc_id"].cast("long") == repeated["_many_id"], "left_anti").unionByName(once)
