"""Chat records: formatting, template rendering, validation, model output text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.jsontext import encode, has_field, is_object
from parley.functions.text import non_blank, strip
from parley.schemas import (
    CHAT_ROLES,
    DEFAULT_SYSTEM_PROMPT,
    EMPTY_ASSISTANT,
    EMPTY_USER,
    LEAD_PREFIX,
    NULL_ASSISTANT,
    NULL_USER,
    WRONG_LENGTH,
)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_format(user: Column, assistant: Column, system: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    contents = (F.lit(system), user, assistant)
    return F.array(*[message(role, content) for role, content in zip(CHAT_ROLES, contents)])


def inference_messages(text: Column, system: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    return F.array(
        message("system", F.lit(system)),
        message("user", F.concat(F.lit(LEAD_PREFIX), text)),
    )


@dataclass(frozen=True)
class Template:
    """Text around each message; ``{role}`` in ``before`` is replaced by the role."""

    start: str
    before: str
    after: str
    eos: str
    strip_content: bool = False


# ---- fixed values: public chat templates -----------------------------------
CHATML = Template("", "<|im_start|>{role}\n", "<|im_end|>\n", "<|im_end|>")
LLAMA3 = Template(
    "<|begin_of_text|>",
    "<|start_header_id|>{role}<|end_header_id|>\n\n",
    "<|eot_id|>",
    "<|eot_id|>",
    strip_content=True,
)


def render_template(conversations: Column, template: Template = LLAMA3, eos: str | None = None) -> Column:
    """Conversation as one training text, end-of-sequence token included."""
    head, tail = template.before.split("{role}")

    def render(m: Column) -> Column:
        content = strip(m["content"]) if template.strip_content else m["content"]
        return F.concat(F.lit(head), m["role"], F.lit(tail), content, F.lit(template.after))

    body = F.array_join(F.transform(conversations, render), "")
    return F.concat(F.lit(template.start), body, F.lit(template.eos if eos is None else eos))


def _content(conversations: Column, role: str) -> Column:
    """Content of the first message of a role; "" without one; NULL when it is null."""
    found = F.filter(conversations, lambda m: m["role"] == role)
    return F.when(F.size(found) == 0, F.lit("")).otherwise(F.get(found, F.lit(0))["content"])


def validate_chat(conversations: Column) -> Column:
    """Reason for rejection, or NULL when the record is good."""
    n = F.coalesce(F.size(conversations), F.lit(0))
    user, assistant = _content(conversations, "user"), _content(conversations, "assistant")
    return (
        F.when(n != 3, F.format_string(WRONG_LENGTH, F.greatest(n, F.lit(0))))
        .when(user.isNull(), F.lit(NULL_USER))
        .when(~non_blank(user), F.lit(EMPTY_USER))
        .when(assistant.isNull(), F.lit(NULL_ASSISTANT))
        .when(~non_blank(assistant), F.lit(EMPTY_ASSISTANT))
    )


def generated_text(output: Column) -> Column:
    """Answer text in a parsed model output (VARIANT); NULL for a list that begins with no object."""
    first = F.try_variant_get(output, "$[0]", "variant")
    return (
        F.when(first.isNotNull() & ~is_object(first), F.lit(None).cast("string"))
        .when(has_field(first, "generated_text"), F.try_variant_get(first, "$.generated_text", "string"))
        .when(has_field(output, "generated_text"), F.try_variant_get(output, "$.generated_text", "string"))
        .when(first.isNull() & is_object(output), encode(output))
        .otherwise(F.lit(""))
    )
