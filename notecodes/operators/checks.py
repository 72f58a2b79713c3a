"""Checks on prepared tables: template presence, emptiness, request ranges, budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notecodes.config import BatchOptions, PrepareOptions
from notecodes.functions.prompts import DEFAULT_TEMPLATE, ChatTemplate
from notecodes.functions.tokens import approx_token_count
from notecodes.operators.clean import fence
from notecodes.operators.split import global_rank

# Accepted request ranges (inclusive).
REQUEST_RANGES = {
    "max_new_tokens": (1, 128),
    "temperature": (0.0, 2.0),
    "top_p": (0.0, 1.0),
    "num_beams": (1, 8),
}


def template_check(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, text_col: str = "text") -> DataFrame:
    """F8 on every row (the reference checks the first row only): one row
    ``rows, rows_without_template``."""
    has = F.col(text_col).contains(F.lit(template.response_template))
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(~F.coalesce(has, F.lit(False))).cast("bigint").alias("rows_without_template"),
    )


def contains_token_run(ids: Column, template_ids: Sequence[int]) -> Column:
    """F8 at token level: ``template_ids`` occur as a contiguous run in ``ids``."""
    k = len(template_ids)
    if k == 0:
        raise ValueError("The response template has no tokens.")
    tmpl = F.array(*[F.lit(int(t)) for t in template_ids])
    starts = F.sequence(F.lit(0), F.size(ids) - k)
    return F.when(F.size(ids) >= k, F.exists(starts, lambda i: F.slice(ids, i + 1, k) == tmpl)).otherwise(F.lit(False))


def require_template(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, text_col: str = "text") -> None:
    row = template_check(df, template, text_col).first()
    if row["rows_without_template"]:
        raise ValueError(f"Response template missing in {row['rows_without_template']} training rows.")


def require_not_empty(df: DataFrame, what: str = "Training dataset") -> None:
    """F9."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows are left.")


def request_violations(requests: DataFrame) -> DataFrame:
    """adds ``violations array<string>`` (names of failed rules) and ``valid``.

    ``note`` must be present (not null); each setting must lie in its range.
    """
    rules = [F.when(F.col("note").isNull(), F.lit("note"))]  # required; "" is a valid note
    for name, (lo, hi) in REQUEST_RANGES.items():
        c = F.col(name)
        rules.append(F.when(c.isNull() | (c < lo) | (c > hi), F.lit(name)))
    # ``concat_ws`` skips NULLs; splitting the result gives the failed rule names
    # without a lambda (``array_compact`` is rewritten into ``filter``).
    joined = F.concat_ws(",", *rules)
    violations = F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))
    return requests.withColumn("violations", violations).withColumn("valid", F.size("violations") == 0)


def over_budget(df: DataFrame, max_seq_length: int, text_col: str = "prompt_text", by: Sequence[str] = ("split",),
                token_count=approx_token_count) -> DataFrame:
    """F13 re-aimed: rows whose prompt would be cut at ``max_seq_length`` tokens,
    per group: ``rows, over_budget, share_over_budget``."""
    flagged = df.withColumn("_over", token_count(F.col(text_col)) > F.lit(max_seq_length))
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if("_over").cast("bigint").alias("over_budget"),
    ).withColumn("share_over_budget", F.col("over_budget") / F.col("rows"))


def length_bucket(tokens: Column, width: int = 128) -> Column:
    return F.floor(tokens / F.lit(width)).cast("bigint")


#: Bytes of text a length-ordered partition holds, about.
ORDERED_BYTES = 64 << 20


def group_by_length(df: DataFrame, num_partitions: int | None = None, text_col: str = "text", token_count=approx_token_count,
                    tie_breaker: str = "example_id") -> DataFrame:
    """L5 re-aimed: range-partition by token length and sort inside partitions, so
    batches read in order hold rows of similar length.

    The unique ``tie_breaker`` is part of the range key, so one very common
    length is split across partitions instead of landing in one. Without
    ``num_partitions``, there are as many as the texts fill.
    """
    if num_partitions is None:
        size = df.agg(F.sum(F.octet_length(text_col)).alias("bytes")).first()["bytes"] or 0
        num_partitions = 1 + size // ORDERED_BYTES
    # the counts cross the exchange twice (bounds, then rows): a fence keeps them from being inlined in the sort
    with_len = fence(df.withColumn("n_tokens", token_count(F.col(text_col))))
    return with_len.repartitionByRange(num_partitions, "n_tokens", tie_breaker).sortWithinPartitions("n_tokens", tie_breaker)


def length_batches(df: DataFrame, opts: BatchOptions = BatchOptions(), text_col: str = "text", token_count=approx_token_count,
                   key: str = "example_id") -> DataFrame:
    """``key, n_tokens, batch, place`` of every row: batches of similar lengths in a random order of rows.

    Rows are shuffled by a seeded hash of their unique ``key``, cut into mega-batches of ``mega_batches``
    batches, sorted inside by length (longest first, then by hash), and cut into batches (numbers from 0;
    the last one may be short). The rank in the shuffled order comes from bucket counts, and a
    mega-batch is one window of a bounded number of rows, so no task sees more.
    """
    rows = df.select(F.col(key).alias("example_id"), token_count(F.col(text_col)).alias("n_tokens"))
    ranked = global_rank(fence(rows), PrepareOptions(seed=opts.seed), "_rank")
    mega = opts.batch_size * opts.mega_batches
    placed = ranked.withColumn("_mega", F.floor((F.col("_rank") - 1) / F.lit(mega)).cast("bigint"))
    order = Window.partitionBy("_mega").orderBy(F.desc("n_tokens"), "_rank")
    at = placed.withColumn("_at", F.row_number().over(order) - 1)
    batch = F.col("_mega") * opts.mega_batches + F.floor(F.col("_at") / F.lit(opts.batch_size)).cast("bigint")
    return at.select(F.col("example_id").alias(key), "n_tokens", batch.alias("batch"), (F.col("_at") % opts.batch_size).cast("int").alias("place"))


def length_buckets(df: DataFrame, width: int = 128, text_col: str = "text", token_count=approx_token_count) -> DataFrame:
    """L5 check: rows per length bucket ``(length_bucket, n)``."""
    return (
        df.select(length_bucket(token_count(F.col(text_col)), width).alias("length_bucket"))
        .groupBy("length_bucket")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )
