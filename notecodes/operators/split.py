"""Seeded exact-size train/validation/test split (W2), limits (L1), invariants.

Rows are ordered by ``split_key = sha256('<seed>:' || example_id)``. The first
``n_train`` keys are train, the next ``n_validation`` validation, the rest test,
so a row's split only needs two threshold keys: the keys at ranks ``n_train``
and ``n_train + n_validation``. They are found on the narrow id column alone:
ids are bucketed by a hex prefix of their key, bucket sizes are counted
(partial aggregation), a running sum over the bucket table (at most ``16**k``
rows, whatever the data size) locates the two target buckets, and only those
two buckets are ranked. The wide rows are then labelled by comparison with a
one-row scalar subquery: no shuffle of wide rows, no task sees the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notecodes.config import PrepareOptions

SPLITS = ("train", "validation", "test")


def split_hash(example_id: Column, seed: int) -> Column:
    """``sha256('<seed>:' || example_id)`` as 64 hex digits."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), example_id), 256)


def split_sizes(n: Column, opts: PrepareOptions) -> dict[str, Column]:
    """Exact split sizes for ``n`` rows, as columns.

    holdout = ceil(hold * n), train = n - holdout, test = ceil(test/hold * holdout),
    validation = holdout - test; products are rounded to 6 places before ``ceil``
    so binary noise cannot add a row.
    """
    hold = opts.val_ratio + opts.test_ratio
    holdout = F.ceil(F.round(F.lit(hold) * n, 6)) if hold > 0 else F.lit(0)
    test_share = opts.test_ratio / hold if hold > 0 else 0.0
    test = F.ceil(F.round(F.lit(test_share) * holdout, 6))
    return {"n_train": n - holdout, "n_validation": holdout - test, "n_test": test}


def _bucketed(ids: DataFrame, opts: PrepareOptions) -> DataFrame:
    key = split_hash(F.col("example_id"), opts.seed)
    return ids.select(key.alias("_key")).withColumn("_bucket", F.substring("_key", 1, opts.rank_bucket_hex_digits))


def _bucket_offsets(keyed: DataFrame) -> DataFrame:
    """``_bucket, _cnt, _offset`` (rows in earlier buckets) and ``_n`` (all rows).

    The windows run over the bucket table, at most ``16**k`` rows.
    """
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "_bucket", "_cnt",
        F.coalesce(F.sum("_cnt").over(running), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_n"),
    )


def split_thresholds(ids: DataFrame, opts: PrepareOptions = PrepareOptions()) -> DataFrame:
    """One row ``t_train, t_validation`` from the distinct kept ids.

    ``t_train`` is the key at rank ``n_train`` and ``t_validation`` the key at
    rank ``n_train + n_validation`` (NULL when that rank is 0).
    """
    keyed = _bucketed(ids, opts)
    offsets = _bucket_offsets(keyed)
    sizes = split_sizes(F.col("_n"), opts)
    wanted = F.array(
        F.struct(F.lit("t_train").alias("name"), sizes["n_train"].alias("rank")),
        F.struct(F.lit("t_validation").alias("name"), (sizes["n_train"] + sizes["n_validation"]).alias("rank")),
    )
    targets = (
        offsets.select("_bucket", "_offset", "_cnt", "_n", F.explode(wanted).alias("t"))
        .where((F.col("t.rank") > F.col("_offset")) & (F.col("t.rank") <= F.col("_offset") + F.col("_cnt")))
        .select("_bucket", "_n", F.col("t.name").alias("name"), (F.col("t.rank") - F.col("_offset")).alias("local"))
    )
    # ``targets`` has at most two rows (two ranks), so the broadcast is bounded;
    # only the rows of those two buckets reach the window.
    local = Window.partitionBy("_bucket").orderBy("_key")
    picked = (
        keyed.join(F.broadcast(targets), "_bucket")
        .withColumn("_rn", F.row_number().over(local))
        .where(F.col("_rn") == F.col("local"))
    )
    return picked.agg(
        F.max(F.when(F.col("name") == "t_train", F.col("_key"))).alias("t_train"),
        F.max(F.when(F.col("name") == "t_validation", F.col("_key"))).alias("t_validation"),
    )


def label_split(key: Column, thresholds: Column) -> Column:
    """``train`` up to ``t_train``, ``validation`` up to ``t_validation``, else ``test``."""
    return (
        F.when(key <= thresholds["t_train"], F.lit("train"))
        .when(key <= thresholds["t_validation"], F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def assign_splits(deduped: DataFrame, opts: PrepareOptions = PrepareOptions(), ids: DataFrame | None = None) -> DataFrame:
    """Add ``split_key`` and ``split`` to deduplicated rows.

    ``ids`` are the distinct kept ids (default: ``deduped.example_id``; pass a
    narrow source, e.g. the distinct accepted ids, so the threshold subquery
    never touches wide columns).
    """
    opts.check()
    ids = deduped.select("example_id") if ids is None else ids
    th = split_thresholds(ids, opts).select(F.struct("t_train", "t_validation").alias("t")).scalar()
    keyed = deduped.withColumn("split_key", split_hash(F.col("example_id"), opts.seed)).withColumn("_t", th)
    return keyed.withColumn("split", label_split(F.col("split_key"), F.col("_t"))).drop("_t")


def global_rank(df: DataFrame, opts: PrepareOptions = PrepareOptions(), rank_col: str = "split_rank") -> DataFrame:
    """Exact 1-based rank by ``split_key`` for every row (unique keys).

    For when the rank itself is wanted: rank = bucket offset + ``row_number``
    inside the bucket; one shuffle of ``df`` by bucket, the offset table is
    bounded by ``16**k`` rows and broadcast.
    """
    keyed = df.withColumn("_key", split_hash(F.col("example_id"), opts.seed)).withColumn(
        "_bucket", F.substring("_key", 1, opts.rank_bucket_hex_digits))
    offsets = _bucket_offsets(keyed.select("_key", "_bucket")).select("_bucket", "_offset")
    local = Window.partitionBy("_bucket").orderBy("_key")
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .withColumn(rank_col, F.col("_offset") + F.row_number().over(local))
        .drop("_bucket", "_offset", "_key")
    )


def split_counts(split_df: DataFrame) -> DataFrame:
    """A2: rows per split (``split``, ``n``)."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def last_in_limit(df: DataFrame, n: int, order_col: str = "split_key") -> Column:
    """The order key at rank ``n`` as a one-row scalar (null when there are fewer rows).

    Keys are unique and hexadecimal hashes, so their prefixes are even buckets; only narrow
    columns are read (bucket counts, then one bucket).
    """
    if n < 0:
        raise ValueError("limit must be >= 0")
    digits = PrepareOptions.rank_bucket_hex_digits
    keyed = df.select(F.col(order_col).alias("_key")).withColumn("_bucket", F.substring("_key", 1, digits))
    target = (
        _bucket_offsets(keyed).where((F.col("_offset") < n) & (F.col("_offset") + F.col("_cnt") >= n))
        .select("_bucket", (F.lit(n) - F.col("_offset")).alias("_local"))  # one row, or none when there are fewer rows
    )
    within = Window.partitionBy("_bucket").orderBy("_key")
    return (
        keyed.join(F.broadcast(target), "_bucket").withColumn("_rn", F.row_number().over(within))
        .where("_rn = _local").agg(F.max("_key").alias("last")).scalar()
    )


def limit_first(df: DataFrame, n: int | None, order_col: str = "split_key") -> DataFrame:
    """L1: the first ``n`` rows in split order; ``None`` keeps all rows.

    Rows are filtered by the key at rank ``n`` where they are, so no sort and no
    single task holds the limit's rows.
    """
    if n is None:
        return df
    if n == 0:
        return df.where(F.lit(False))
    last = last_in_limit(df, n, order_col)
    return df.withColumn("_last", last).where(F.coalesce(F.col(order_col) <= F.col("_last"), F.lit(True))).drop("_last")


#: Rows that one task ranks when a key is looked up by rank.
RANKED_ROWS = 1 << 16
_CUTS = 256


def key_at_rank(df: DataFrame, n: int, key: Column, most: int = RANKED_ROWS) -> int | float | None:
    """The ``n``-th smallest value (from 1) of a numeric key, however unevenly it is spread; None when there are fewer rows.

    Each round counts the rows up to and between two keys, and takes splitters of the rows between from a quantile
    sketch; the next two keys are the splitters around the rank. A round shrinks the rows between about
    fiftyfold whatever the keys are, reads one narrow column and returns one row. A frequent key ends up as one of the two.
    """
    keyed = df.select(key.alias("_key")).where("_key IS NOT NULL")
    cuts = [i / _CUTS for i in range(_CUTS + 1)]
    k, low, high = F.col("_key"), None, None  # the key at the rank is low, high, or between them
    while True:
        over = F.lit(True) if low is None else k > F.lit(low)
        between = over if high is None else over & (k < F.lit(high))
        inner = F.when(between, k)
        seen = keyed.agg(
            F.count_if(~over).alias("below"), F.count(inner).alias("between"), F.min(inner).alias("least"), F.max(inner).alias("most"),
            F.percentile_approx(inner, cuts, 10_000).alias("cuts"),
        ).first()
        wanted = n - seen["below"]
        if wanted <= 0:
            return low
        if wanted > seen["between"]:
            return high
        if seen["least"] == seen["most"]:
            return seen["least"]
        if seen["between"] <= most:
            break
        # a splitter's rank is off by at most a ten-thousandth, so two places around the rank hold it for certain
        at = wanted * _CUTS // seen["between"]
        low = seen["cuts"][at - 2] if at >= 2 else low
        high = seen["cuts"][at + 2] if at + 2 <= _CUTS else high
    counts = keyed.where(between).groupBy("_key").agg(F.count(F.lit(1)).alias("c"))
    running = counts.withColumn("cum", F.sum("c").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)))  # at most ``most`` rows
    return running.where(F.col("cum") >= wanted).agg(F.min("_key")).first()[0]


def up_to_rank(df: DataFrame, n: int | None, order_col: str, most: int = RANKED_ROWS) -> DataFrame:
    """The rows of the ``n`` smallest unique numeric keys, left where they are."""
    if n is None:
        return df
    if n < 0:
        raise ValueError("limit must be >= 0")
    last = key_at_rank(df, n, F.col(order_col), most) if n else None
    if n == 0:
        return df.where(F.lit(False))
    return df if last is None else df.where(F.col(order_col) <= F.lit(last))


def split_invariants(split_df: DataFrame) -> DataFrame:
    """X8 as a long table ``(check, n)``: total rows, rows in a known split, distinct
    ids, ids in more than one split (must be 0), and notes in more than one split
    (allowed: one note with two different targets has two ids)."""
    totals = split_df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_if(F.col("split").isin(*SPLITS)).cast("bigint").alias("rows_in_splits"),
    )
    per_id = split_df.groupBy("example_id").agg(F.count_distinct("split").alias("k")).agg(
        F.count(F.lit(1)).cast("bigint").alias("distinct_ids"),
        F.count_if(F.col("k") > 1).cast("bigint").alias("ids_in_two_splits"),
    )
    per_note = (
        split_df.groupBy(F.sha2(F.col("ehr_text"), 256).alias("note_hash"))
        .agg(F.count_distinct("split").alias("k"))
        .agg(F.count_if(F.col("k") > 1).cast("bigint").alias("notes_in_two_splits"))
    )

    def long(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]),
                                                     F.array(*[F.col(c) for c in df.columns]))).alias("check", "n"))

    return long(totals).unionByName(long(per_id)).unionByName(long(per_note))
