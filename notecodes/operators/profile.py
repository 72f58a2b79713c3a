"""Profiling: counts, instruction profile, numeric summaries, the dataset report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notecodes.functions.tokens import approx_token_count
from notecodes.operators.split import up_to_rank
from notecodes.session import spread, staged

# The reported percentiles.
PERCENTILES = (50, 90, 95, 99)
# The series that every row has a value in.
CODE_SERIES = "num_codes_per_example"
SUMMARY_FIELDS = ("count", "min", "max", "mean") + tuple(f"p{p}" for p in PERCENTILES)


def first_rows(df: DataFrame, n: int | None, order_col: str = "row_no") -> DataFrame:
    """L2: the first ``n`` rows in source order (not a random sample); ``None`` = all."""
    return up_to_rank(df, n, order_col)


#: Parts that a value histogram is cut into; each is summed up in a task of its own.
PARTS = 128


def even_shares(parts: int) -> Column:
    """1 / parts, 2 / parts, ... below 1, as one literal (a plan with hundreds of them takes long to make)."""
    return F.split(F.lit(" ".join(str(i / parts) for i in range(1, parts))), " ").cast("array<double>")


def value_counts(df: DataFrame, value_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., _v, _c``: rows per distinct value, nulls left out."""
    v = F.col(value_col)
    return df.where(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def numeric_summary(df: DataFrame, value_col: str, by: Sequence[str] = (),
                    percentiles: Sequence[int] = PERCENTILES) -> DataFrame:
    """A4 + A5: ``count, min, max, mean`` and nearest-rank percentiles, as doubles."""
    return summary_of_counts(staged(value_counts(df, value_col, by), "value_counts"), by, percentiles)


#: Distinct values up to which one window counts through a whole histogram.
ONE_WINDOW = 1 << 18


def percentile_index(n: Column, p: int) -> Column:
    """0-based place of percentile ``p`` among ``n`` sorted values: ``min(n - 1, rint(p / 100 * (n - 1)))``."""
    return F.least(n - 1, F.rint(F.lit(p / 100) * (n - 1)))


def summary_of_counts(hist: DataFrame, by: Sequence[str] = (), percentiles: Sequence[int] = PERCENTILES, one_window: int = ONE_WINDOW) -> DataFrame:
    """The summary of ``value_counts`` (best read from a written table).

    Percentiles are nearest ranks (round half to even, like Python's ``round``). Neither
    ``percentile`` (interpolates) nor ``percentile_disc`` (ceil rank) gives that, so each is the
    first value whose running count exceeds the index. A histogram of few distinct values is
    counted through in one window; beyond ``one_window`` of them, in parts (``summary_in_parts``): the
    rows are the same. Empty input gives no row (the reference returns an empty summary).
    """
    if hist.count() > one_window:
        return summary_in_parts(hist, by, percentiles)
    part = Window.partitionBy(*by)
    cum = hist.select(
        *by, "_v", "_c", F.sum("_c").over(part.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"), F.sum("_c").over(part).alias("_n"))
    aggs = [
        F.first("_n").cast("double").alias("count"), F.min("_v").cast("double").alias("min"), F.max("_v").cast("double").alias("max"),
        (F.sum(F.col("_v").cast("double") * F.col("_c")) / F.first("_n")).alias("mean"),
    ]
    for p in percentiles:
        aggs.append(F.min(F.when(F.col("_cum") > percentile_index(F.col("_n"), p), F.col("_v"))).cast("double").alias(f"p{p}"))
    # A global aggregate over no rows still yields one (all-NULL) row: drop it.
    return cum.groupBy(*by).agg(*aggs).where(F.col("count").isNotNull())


def summary_in_parts(hist: DataFrame, by: Sequence[str] = (), percentiles: Sequence[int] = PERCENTILES, parts: int = PARTS) -> DataFrame:
    """The summary of a histogram of any number of distinct values.

    Splitters from a quantile sketch cut the distinct values of a group into up to ``parts`` ranges, the
    ranges' sums give each one's offset, and only the ranges that hold a wanted index are counted
    through, each in its own window. So a column of as many distinct values as rows is no
    single task's work. Groups are few (metrics, splits): their splitters and sums, ``parts`` values each, are broadcast.
    """
    hist = hist.withColumn("_all", F.lit(0))
    keys = [*by, "_all"]
    cuts = hist.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("_v", even_shares(parts), 10_000)).alias("_cuts"))
    # the place of a value among the splitters: one more than the splitters below it
    ranged = hist.join(F.broadcast(cuts), keys).select(*keys, "_v", "_c", F.array_position(F.sort_array(F.array_append("_cuts", F.col("_v"))), F.col("_v")).alias("_part"))
    sums = ranged.groupBy(*keys, "_part").agg(
        F.sum("_c").alias("_sum"), F.sum(F.col("_v").cast("double") * F.col("_c")).alias("_total"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    within = Window.partitionBy(*keys)
    offsets = sums.select(
        *keys, "_part", "_sum", F.coalesce(F.sum("_sum").over(within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_sum").over(within).alias("_n"), F.min("_least").over(within).alias("_min"), F.max("_most").over(within).alias("_max"), F.sum("_total").over(within).alias("_all_total"),
    )
    n = F.col("_n")
    index = {p: percentile_index(n, p) for p in percentiles}
    has = F.lit(False)
    for i in index.values():
        has = has | ((i >= F.col("_before")) & (i < F.col("_before") + F.col("_sum")))
    wanted = offsets.where(has).drop("_sum")
    running = F.sum("_c").over(Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    counted = ranged.join(F.broadcast(wanted), [*keys, "_part"]).withColumn("_cum", F.col("_before") + running)
    aggs = [
        F.first("_n").cast("double").alias("count"), F.first("_min").cast("double").alias("min"), F.first("_max").cast("double").alias("max"),
        (F.first("_all_total") / F.first("_n")).alias("mean"),
    ]
    for p, i in index.items():
        inside = (F.col("_cum") > i) & (F.col("_cum") - F.col("_c") <= i)
        aggs.append(F.min(F.when(inside, F.col("_v"))).cast("double").alias(f"p{p}"))
    return counted.groupBy(*keys).agg(*aggs).where(F.col("count").isNotNull()).drop("_all")


def profile_series(sample: DataFrame, token_count=approx_token_count, keep: Sequence[str] = ()) -> DataFrame:
    """The three profile series in long form ``(metric, value)``, with the columns to ``keep``."""
    series = sample.select(
        *keep,
        F.explode(
            F.array(
                F.struct(F.lit("prompt_token_length").alias("metric"), token_count(F.col("prompt_text")).alias("value")),
                F.struct(F.lit("full_text_token_length").alias("metric"), token_count(F.col("text")).alias("value")),
                F.struct(F.lit(CODE_SERIES).alias("metric"), F.col("num_codes").cast("int").alias("value")),
            )
        ).alias("s")
    )
    return series.select(*keep, "s.metric", "s.value")


def instruction_profile(raw: DataFrame) -> DataFrame:
    """A3 + L3 per distinct raw instruction (unstripped; NULL is a value).

    Columns ``instruction, first_row, n``. ``count_distinct`` would drop NULL,
    so this groups instead.
    """
    return raw.groupBy("instruction").agg(
        F.min("row_no").alias("first_row"), F.count(F.lit(1)).cast("bigint").alias("n")
    )


def instruction_preview(raw: DataFrame, k: int = 3) -> DataFrame:
    """L3: the first ``k`` distinct instructions in first-seen order."""
    return instruction_profile(raw).orderBy("first_row").limit(k).select("instruction", "first_row")


def created_at_utc() -> Column:
    """Now as UTC text, whatever the session's time zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def summary_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + f).alias(f) for f in SUMMARY_FIELDS])


def dataset_report(raw: DataFrame, split_df: DataFrame, stats: DataFrame, sample_size: int | None,
                   token_count=approx_token_count) -> DataFrame:
    """One row holding the whole report.

    ``created_at_utc, raw_rows, clean_rows, splits, columns, unique_instruction_count,
    instruction_preview, cleaning_stats, sample_size_for_report`` and three summaries.
    The written table is read once, for the counts of values per split and series, which give sizes and
    summaries; the statistics come from narrow columns of the staged rows, and the instructions from the
    raw ones. Each part is reduced to one row over a bounded input, and the parts are
    stacked with a union and folded into one row, so no join is needed.
    """
    sample = spread(first_rows(split_df.select("split", "row_no", "prompt_text", "text", "num_codes"), sample_size), "row_no")
    # the one pass over the written texts: rows per split, series and value
    counts = staged(value_counts(profile_series(sample, token_count, keep=("split",)), "value", ("split", "metric")), "value_counts")
    summaries = summary_of_counts(counts.groupBy("metric", "_v").agg(F.sum("_c").alias("_c")), ("metric",))
    if sample_size is None:
        sizes = counts.where(F.col("metric") == CODE_SERIES).groupBy("split").agg(F.sum("_c").alias("count"))
    else:
        sizes = split_df.groupBy("split").count()
    instructions = instruction_profile(raw)
    parts = [
        instructions.agg(F.sum("n").cast("bigint").alias("raw_rows"),
                         F.count(F.lit(1)).cast("bigint").alias("unique_instruction_count")),
        sizes.agg(
            F.sum("count").cast("bigint").alias("clean_rows"),
            F.map_from_entries(F.collect_list(F.struct("split", F.col("count").cast("bigint")))).alias("splits"),
        ),
        instructions.orderBy("first_row").limit(3).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("first_row", "instruction"))),
                        lambda s: s["instruction"]).alias("instruction_preview")
        ),
        stats.agg(F.map_from_entries(F.collect_list(F.struct("stat", "n"))).alias("cleaning_stats")),
        summaries.agg(F.map_from_entries(F.collect_list(F.struct("metric", summary_struct()))).alias("_m")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    return folded.select(
        created_at_utc().alias("created_at_utc"),
        "raw_rows", "clean_rows", "splits",
        F.array(*[F.lit(c) for c in raw.columns if c != "row_no"]).alias("columns"),
        "unique_instruction_count", "instruction_preview", "cleaning_stats",
        # every sampled row has a code count, so that series' count is the sample size
        F.coalesce(F.col("_m")["num_codes_per_example"]["count"].cast("bigint"), F.lit(0).cast("bigint"))
        .alias("sample_size_for_report"),
        F.col("_m")["prompt_token_length"].alias("prompt_token_length"),
        F.col("_m")["full_text_token_length"].alias("full_text_token_length"),
        F.col("_m")["num_codes_per_example"].alias("num_codes_per_example"),
    )
