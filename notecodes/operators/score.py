"""Batch scoring (U2) through a user predictor, and parsing of raw predictions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from notecodes.config import PredictOptions
from notecodes.functions.codes import PYTHON_CODE_PATTERN, extract_codes
from notecodes.functions.prompts import prompt_text, system_prompt
from notecodes.functions.text import clean_text
from notecodes.functions.tokens import approx_cut
from notecodes.session import bound_batches, ship_package

#: Generation settings that a request may bring along.
SETTINGS = ("max_new_tokens", "temperature", "top_p", "do_sample", "num_beams")

#: Predictors of different settings that a task holds at most; the one unused for longest goes first.
KEPT_PREDICTORS = 256

Predictor = Callable[[list[str]], list[str]]
PredictorFactory = Callable[[PredictOptions], Predictor]

_CODE_RE = re.compile(PYTHON_CODE_PATTERN)


def _canonical_codes(text: str) -> str:
    seen: dict[str, None] = {}
    for match in _CODE_RE.findall(text.upper()):
        flat = match.replace(".", "")
        seen.setdefault(f"{flat[:3]}.{flat[3:]}" if len(flat) > 3 else flat, None)
    return ", ".join(seen)


def rule_predictor(options: PredictOptions) -> Predictor:
    """Deterministic stand-in for a model: answers with the codes written in the
    user turn of the prompt. For tests and plumbing, not a model."""
    user_start = options.template.header(options.template.user_role)
    eot = options.template.eot

    def predict(prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            note = p.split(user_start, 1)[-1].split(eot, 1)[0] if p else ""
            out.append(_canonical_codes(note))
        return out

    return predict


def echo_settings(options: PredictOptions) -> Predictor:
    """Answers with the settings it was built with (to see what reaches a predictor)."""
    said = f"{options.max_new_tokens} {options.num_beams} {round(options.temperature * 10)} {round(options.top_p * 10)} {int(options.do_sample)}"
    return lambda prompts: [said] * len(prompts)


def batch_predict(df: DataFrame, factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions(),
                  prompt_col: str = "prompt_text", out_col: str = "prediction", settings: tuple[str, ...] = (),
                  cut: Callable[[str, int], tuple[str, bool]] = approx_cut) -> DataFrame:
    """Every row of ``df`` plus ``out_col`` predicted from ``prompt_col``.

    The predictor is built once per task (a model load), then called on slices of
    ``batch_size`` prompts. Columns named in ``settings`` are a row's own
    generation settings: one predictor per distinct setting (of more than ``KEPT_PREDICTORS`` in a task,
    one that was dropped is built anew when its setting comes again). All columns of ``df`` travel
    to Python and back, so pass the narrow ones. They come in Arrow batches of a few MB, of which
    only the prompts and the settings become Python values. Nothing is collected.

    With ``options.max_seq_length``, the predictor gets each prompt cut to that many tokens by
    ``cut`` (the tokenizer's plug point: ``(text, tokens) -> (text, was it cut)``), and a column ``was_cut`` says so.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    batch = max(1, options.batch_size)
    most = options.max_seq_length
    schema = StructType(df.schema.fields + [StructField(out_col, StringType(), True)] + ([StructField("was_cut", BooleanType(), True)] if most else []))
    own = [c for c in settings if c in df.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(KEPT_PREDICTORS)
        def predictor(values: tuple) -> Predictor:
            return factory(replace(options, **dict(zip(own, values))))

        for part in batches:
            prompts = [p or "" for p in part.column(prompt_col).to_pylist()]
            cuts = [cut(p, most) for p in prompts] if most else []
            if most:
                prompts = [text for text, _ in cuts]
            # rows of equal settings are predicted together; answers keep the rows' order
            rows: dict[tuple, list[int]] = {}
            for i, values in enumerate(zip(*(part.column(c).to_pylist() for c in own)) if own else [()] * len(prompts)):
                rows.setdefault(values, []).append(i)
            preds = [""] * len(prompts)
            for values, at in rows.items():
                predict = predictor(values)
                for k in range(0, len(at), batch):
                    for i, x in zip(at[k:k + batch], predict([prompts[j] for j in at[k:k + batch]])):
                        preds[i] = str(x).strip()
            new = [pa.array(preds, pa.string())] + ([pa.array([was for _, was in cuts], pa.bool_())] if most else [])
            yield pa.RecordBatch.from_arrays(part.columns + new, schema.names)

    return df.mapInArrow(run, schema)


def parse_predictions(df: DataFrame, raw_col: str = "raw_prediction") -> DataFrame:
    """Stripped raw text, its canonical code string and the code array."""
    raw = clean_text(F.col(raw_col))
    codes = extract_codes(raw)
    return df.withColumns({
        raw_col: raw,
        "normalized_prediction": F.array_join(codes, ", "),
        "codes": codes,
    })


def note_prompts(notes: DataFrame, options: PredictOptions = PredictOptions()) -> DataFrame:
    """Default the instruction, then build the generation prompt for each note."""
    system = system_prompt(clean_text(F.col("instruction")), options.system_prompt)
    return notes.withColumn("prompt_text", prompt_text(system, clean_text(F.col("note")), options.template))


def score_notes(notes: DataFrame, factory: PredictorFactory = rule_predictor, options: PredictOptions = PredictOptions(),
                key: str = "row_no") -> DataFrame:
    """Batch inference over a note table: ``note`` + prompt + parsed prediction."""
    own = [c for c in SETTINGS if c in notes.columns]
    prompted = note_prompts(notes, options).select(key, "note", "prompt_text", *own)
    predicted = batch_predict(prompted, factory, options, out_col="raw_prediction", settings=tuple(own))
    return parse_predictions(predicted.drop(*own))
