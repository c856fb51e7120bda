"""Expressions over turn arrays (`ARRAY<STRUCT<role,content>>`) and command arrays.

Null arrays read as empty; null roles and contents as the empty string.  Roles are
lower-cased where the raw table is read (`role_of`), never trimmed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import detect, text
from quillspan.schema import TURNS


def role_of(turn: Column) -> Column:
    return F.lower(F.coalesce(turn["role"], F.lit("")))


def content_of(turn: Column) -> Column:
    return F.coalesce(turn["content"], F.lit(""))


def or_empty(messages: Column) -> Column:
    return F.coalesce(messages, F.array().cast(TURNS))


def assistant_contents(messages: Column) -> Column:
    """Contents of the assistant turns in order."""
    own = F.filter(or_empty(messages), lambda t: role_of(t) == "assistant")
    return F.transform(own, content_of)


def assistant_count(messages: Column) -> Column:
    return F.size(F.filter(or_empty(messages), lambda t: role_of(t) == "assistant"))


def first_edit_index(messages: Column) -> Column:
    """1-based ordinal, among assistant turns, of the first whose text is an edit; 0 if none."""
    flags = F.transform(assistant_contents(messages), detect.is_edit)
    return F.array_position(flags, F.lit(True)).cast("int")


def _assistant_positions(messages: Column) -> Column:
    marked = F.transform(messages, lambda t, i: F.when(role_of(t) == "assistant", i))
    return F.array_compact(marked)


def cut_before(messages: Column, turn_idx: Column) -> Column:
    """Turns before assistant turn `turn_idx` (0-based); null unless there is such a turn.

    Turns of empty content are left out after cutting; roles other than assistant,
    system and user become user.
    """
    whole = or_empty(messages)
    at = F.get(_assistant_positions(whole), turn_idx)
    head = F.filter(F.slice(whole, F.lit(1), F.coalesce(at, F.lit(0))), lambda t: content_of(t) != "")
    clean = F.transform(
        head,
        lambda t: F.struct(
            F.when(role_of(t).isin("assistant", "system", "user"), role_of(t)).otherwise("user").alias("role"),
            content_of(t).alias("content"),
        ),
    )
    return F.when(at.isNotNull(), clean)


def char_count(messages: Column) -> Column:
    """Sum of content lengths in code points; 0 for a null array."""
    return F.aggregate(
        or_empty(messages), F.lit(0).cast("long"), lambda acc, t: acc + F.length(content_of(t))
    )


def phase_of(prefix: Column) -> Column:
    """at_edit if an assistant turn is an edit, else cold up to two assistant turns, else pre_edit."""
    own = assistant_contents(prefix)
    return (
        F.when(F.exists(own, detect.is_edit), "at_edit").when(F.size(own) <= 2, "cold").otherwise("pre_edit")
    )


def can_cut(asst: Column, phase: str, turn_idx: Column, prefix: Column) -> Column:
    """More assistant turns than `turn_idx`, and, except for cold, a prefix within the character limit."""
    fits = F.lit(True) if phase == "cold" else char_count(prefix) <= V.MAX_PREFIX_CHARS
    return (asst > turn_idx) & prefix.isNotNull() & fits


def commands_of(messages: Column) -> Column:
    """First fenced command of each assistant turn, without empty ones (role compared as it stands)."""
    own = F.filter(or_empty(messages), lambda t: t["role"] == "assistant")
    return F.filter(F.transform(own, lambda t: text.first_command(t["content"])), lambda c: c != "")


def prefix_of(messages: Column, continuation: Column) -> Column:
    """The messages before the continuation; empty if either is null or empty.

    A continuation longer than the messages (malformed) gives an empty prefix.
    """
    whole, tail = or_empty(messages), or_empty(continuation)
    n = F.greatest(F.size(whole) - F.size(tail), F.lit(0))
    return F.when((F.size(whole) > 0) & (F.size(tail) > 0), F.slice(whole, F.lit(1), n)).otherwise(
        F.array().cast(TURNS)
    )


def longest_equal_run(commands: Column) -> Column:
    """Length of the longest run of equal neighbours; 0 for an empty array."""
    start = F.struct(
        F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("most")
    )

    def step(acc: Column, c: Column) -> Column:
        run = F.when(acc["prev"].eqNullSafe(c) & (acc["run"] > 0), acc["run"] + 1).otherwise(1)
        return F.struct(c.alias("prev"), run.alias("run"), F.greatest(acc["most"], run).alias("most"))

    return F.aggregate(commands, start, step, lambda acc: acc["most"])


def duplicate_ratio(commands: Column) -> Column:
    """1 - distinct / all; null for an empty array."""
    return F.lit(1.0) - F.try_divide(F.size(F.array_distinct(commands)), F.size(commands))
