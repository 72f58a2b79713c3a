"""Token counting (U1): a built-in approximation and a plug point for real tokenizers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Approximate tokenizer: a run of ASCII word characters, or any single character
# that is neither a word character nor ASCII white space. It is NOT any model's
# tokenizer; it is a deterministic stand-in that scales with text length.
APPROX_TOKEN_PATTERN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_ \t\n\x0B\f\r]"


def approx_token_count(text: Column) -> Column:
    """Approximate token count, JVM-side (no Python worker).

    Each run of word characters becomes one character and white space goes; what is left has a character
    a token. (Counting the pattern's matches builds an array of them first.)
    """
    short = F.regexp_replace(F.coalesce(text, F.lit("")), "[0-9A-Za-z_]+", "a")
    return F.length(F.translate(short, " \t\n\x0B\f\r", "")).cast("int")


_APPROX_TOKEN = re.compile(APPROX_TOKEN_PATTERN)


def approx_cut(text: str, most: int) -> tuple[str, bool]:
    """``text`` up to the end of its ``most``-th approximate token, and whether more tokens follow."""
    ends = [m.end() for m in islice(_APPROX_TOKEN.finditer(text), most + 1)]
    if len(ends) <= most:
        return text, False
    return text[:ends[most - 1]] if most else "", True


def tokenizer_count_udf(load_tokenizer: Callable[[], Callable[[list[str]], list[list]]]):
    """Wrap a user tokenizer as an iterator pandas UDF returning token counts.

    ``load_tokenizer()`` runs once per Python worker task (not per row); the
    returned callable maps a batch of texts to their token ids, without special tokens.
    """

    @F.pandas_udf("int")
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_tokenizer()
        for texts in batches:
            yield pd.Series([len(ids) for ids in encode(texts.fillna("").tolist())], index=texts.index, dtype="int32")

    return count_tokens
