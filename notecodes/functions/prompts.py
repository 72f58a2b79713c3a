"""Chat-prompt column builders; the chat format is a template object."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from notecodes.functions.codes import PYTHON_CODE_PATTERN, canonical_text

# Our own default system prompt. It must hold no code-like word (checked by a test),
# otherwise every row would be rejected for leakage into the prompt.
DEFAULT_SYSTEM_PROMPT = (
    "You are a clinical coding assistant. Read the patient note and answer with the "
    "diagnosis codes that apply, separated by commas. Give the codes only, with no "
    "explanation."
)


@dataclass(frozen=True)
class ChatTemplate:
    """Special tokens of a chat format.

    Fixed values (default): begin-of-text ``<|begin_of_text|>``, header start
    ``<|start_header_id|>``, header end ``<|end_header_id|>``, end of turn
    ``<|eot_id|>``; a header is followed by two newlines.
    """

    bos: str = "<|begin_of_text|>"
    start_header: str = "<|start_header_id|>"
    end_header: str = "<|end_header_id|>"
    eot: str = "<|eot_id|>"
    header_suffix: str = "\n\n"
    system_role: str = "system"
    user_role: str = "user"
    assistant_role: str = "assistant"

    def header(self, role: str) -> str:
        return f"{self.start_header}{role}{self.end_header}{self.header_suffix}"

    @property
    def response_template(self) -> str:
        """The assistant header: where the completion starts."""
        return self.header(self.assistant_role)

    def literal_parts(self) -> list[str]:
        return [
            self.bos + self.header(self.system_role),
            self.eot + self.header(self.user_role),
            self.eot + self.header(self.assistant_role),
        ]

    def isolates_fields(self) -> bool:
        """True when no code can sit in, or cross into, the template's own text.

        Codes are made of ``[A-Z0-9.]`` with a digit second. When the template has
        no digit and every literal part begins and ends outside that alphabet, a
        leak in the whole prompt is a leak in the system prompt or in the note, so
        the two short fields can be tested instead of the long prompt.
        """
        parts = self.literal_parts()
        code_chars = re.compile(r"[A-Za-z0-9.]")
        return (
            not any(ch.isdigit() for p in parts for ch in p)
            and all(p and not code_chars.match(p[0]) and not code_chars.match(p[-1]) for p in parts)
            and not any(re.search(PYTHON_CODE_PATTERN, p.upper()) for p in parts)
        )


DEFAULT_TEMPLATE = ChatTemplate()


def system_prompt(instruction: Column, default: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Stripped instruction, or the default when it is empty (input already stripped)."""
    return F.when(F.coalesce(instruction, F.lit("")) != "", instruction).otherwise(F.lit(default))


def prompt_text(system: Column, note: Column, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """Generation prompt: BOS, system turn, user turn, open assistant turn."""
    t = template
    return F.concat(
        F.lit(t.bos + t.header(t.system_role)),
        system,
        F.lit(t.eot + t.header(t.user_role)),
        note,
        F.lit(t.eot + t.header(t.assistant_role)),
    )


def training_text(prompt: Column, target_text: Column, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """Prompt + canonical target + end of turn; NULL when the target is empty."""
    normalized = canonical_text(target_text)
    return F.when(normalized != "", F.concat(prompt, normalized, F.lit(template.eot)))


def completion_text(target_text: Column, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """Completion for prompt/completion training: target + end of turn."""
    return F.concat(target_text, F.lit(template.eot))


def chat_messages(system: Column, note: Column, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """``array<struct<role, content>>`` with the system and the user message."""
    return F.array(
        F.struct(F.lit(template.system_role).alias("role"), system.alias("content")),
        F.struct(F.lit(template.user_role).alias("role"), note.alias("content")),
    )
