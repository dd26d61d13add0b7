"""Column expressions on chat samples: normalisation and templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import python_str, strip, variant_field

# Markers of the chat template and the default system turn.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
SYSTEM_TEXT = "你是一个AI助手。"
INPUT_HEADER = "\n\n输入：\n"

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def instruction_messages(instruction: Column, extra: Column, output: Column) -> Column:
    """System, user and assistant turns of an instruction sample (all three non-NULL)."""
    user = F.when(strip(extra) == "", strip(instruction)).otherwise(
        F.concat(strip(instruction), F.lit(INPUT_HEADER), strip(extra))
    )
    return F.array(
        message("system", F.lit(SYSTEM_TEXT)), message("user", user), message("assistant", strip(output))
    )


# Names of an instruction sample's fields; the second name counts only when the first is absent.
INSTRUCTION, INPUT, OUTPUT = ("instruction", "human"), ("input",), ("output", "assistant")
SAMPLE_FIELDS = INSTRUCTION + INPUT + OUTPUT


def built_messages(field: Callable[[str], Column]) -> Column:
    """Messages of an instruction sample; ``field(name)`` is Python's ``str()`` of a field, NULL when absent."""
    def first(names: tuple[str, ...]) -> Column:
        return F.coalesce(*map(field, names), F.lit(""))

    return instruction_messages(first(INSTRUCTION), first(INPUT), first(OUTPUT))


def record_messages(record: Column) -> Column:
    """Messages of a variant record that is an object: its ``messages`` when the key is there, else its fields.

    NULL when ``messages`` is neither empty (or null, false, 0) nor a list of objects with role and content.
    """
    def text(name: str) -> Column:
        value = variant_field(record, name)
        return F.when(value.isNotNull(), python_str(value))

    def has_both(m: Column) -> Column:
        return variant_field(m, "role").isNotNull() & variant_field(m, "content").isNotNull()

    def as_message(m: Column) -> Column:
        return message(python_str(variant_field(m, "role")), python_str(variant_field(m, "content")))

    given = variant_field(record, "messages")
    items = F.try_variant_get(given, "$", "array<variant>")
    falsy = F.is_variant_null(given) | F.schema_of_variant(given).isin("OBJECT<>", "VOID") | F.coalesce(
        python_str(given).isin("", "0", "0.0", "-0.0", "False"), F.lit(False))
    listed = F.when(F.forall(items, has_both), F.transform(items, as_message))
    return (
        F.when(given.isNull(), built_messages(text)).when(items.isNotNull(), listed)
        .when(falsy, F.array().cast(MESSAGES_TYPE))
    )


def render_message(role: Column, content: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(TURN_END + "\n"))


def render_chat(messages: Column, add_generation_prompt: bool = False) -> Column:
    """All messages through the template, optionally with an open assistant turn."""
    body = F.array_join(F.transform(messages, lambda m: render_message(m["role"], m["content"])), "")
    return F.concat(body, F.lit(f"{TURN_START}assistant\n")) if add_generation_prompt else body


def generation_prompt(user: Column) -> Column:
    """The prompt for one user question under the default system turn."""
    return render_chat(
        F.array(message("system", F.lit(SYSTEM_TEXT)), message("user", user)), add_generation_prompt=True
    )
