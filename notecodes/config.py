"""Job options: one frozen dataclass per job, passed to functions.

Fixed values (the defaults to match): raw split "train", seed 42, ratios
train 0.9 / validation 0.05 / test 0.05, maximum sequence length 1024 tokens;
evaluation on split "test" with batch size 4, 32 new tokens, temperature 0.0,
top_p 1.0, no sampling, one beam. Row limits (report sample, training,
validation, evaluation) are off unless asked for: every row counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from notecodes.functions.prompts import DEFAULT_SYSTEM_PROMPT, DEFAULT_TEMPLATE, ChatTemplate


@dataclass(frozen=True)
class PrepareOptions:
    raw_split: str = "train"
    seed: int = 42
    train_ratio: float = 0.9
    val_ratio: float = 0.05
    test_ratio: float = 0.05
    sample_report_size: int | None = None
    system_prompt: str = DEFAULT_SYSTEM_PROMPT
    template: ChatTemplate = field(default=DEFAULT_TEMPLATE)
    # Hex digits of the split hash used as rank buckets: 16**k buckets, so the
    # offset table that is broadcast has at most 16**k rows whatever the data size.
    rank_bucket_hex_digits: int = 4
    # Spread the raw rows over the cluster before the regex work: True, False,
    # or None = only when the whole input is small (a few MB a task slot: few row
    # groups that would otherwise each be one task).
    rebalance_input: bool | None = None
    # Deal the rows out by split before the write, so that files follow a split's bytes: True, False,
    # or None = unless the whole input is small (then a few tasks write a few files anyway).
    rebalance_output: bool | None = None
    # Parquet codec of the written table (text compresses well with zstd; the
    # temporary staged table keeps Spark's default, faster codec).
    output_compression: str = "zstd"

    def check(self) -> None:
        """Ratios must sum to one (rounded to 6 places) and each be in [0, 1]."""
        total = round(self.train_ratio + self.val_ratio + self.test_ratio, 6)
        if total != 1.0:
            raise ValueError(f"Split ratios add up to {total}, not to 1.")
        if min(self.train_ratio, self.val_ratio, self.test_ratio) < 0:
            raise ValueError("Ratios must not be negative.")
        if not 1 <= self.rank_bucket_hex_digits <= 6:
            raise ValueError("rank_bucket_hex_digits must be in 1..6.")


@dataclass(frozen=True)
class TrainingShapeOptions:
    max_train_samples: int | None = None
    max_eval_samples: int | None = None
    max_seq_length: int = 1024
    template: ChatTemplate = field(default=DEFAULT_TEMPLATE)


@dataclass(frozen=True)
class BatchOptions:
    """Length-grouped training batches."""

    batch_size: int = 4
    # Batches of a mega-batch: rows are shuffled, cut into mega-batches and sorted by length inside.
    mega_batches: int = 50
    seed: int = 42


@dataclass(frozen=True)
class GenerationOptions:
    max_new_tokens: int = 32
    temperature: float = 0.0
    top_p: float = 1.0
    do_sample: bool = False
    num_beams: int = 1
    batch_size: int = 4
    # Prompts of more tokens are cut before prediction and flagged (``was_cut``); None leaves them whole.
    max_seq_length: int | None = None


@dataclass(frozen=True)
class EvaluateOptions(GenerationOptions):
    split: str = "test"
    max_samples: int | None = None
    model_id: str = "rule-predictor"


@dataclass(frozen=True)
class PredictOptions(GenerationOptions):
    system_prompt: str = DEFAULT_SYSTEM_PROMPT
    template: ChatTemplate = field(default=DEFAULT_TEMPLATE)
