"""Identifiers and the scalar choices derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.schema import truthy


def family_of(instance_id: Column, source: Column) -> Column:
    """pr, lm, combine or mechanical, from the id's last dotted part; pr-only sources are always pr."""
    tail = F.substring_index(instance_id, ".", -1)
    return (
        F.when(source.isin(*V.PR_ONLY_SOURCES), "pr")
        .when(F.instr(instance_id, ".") == 0, "pr")
        .when(F.startswith(tail, F.lit("pr_")), "pr")
        .when(F.startswith(tail, F.lit("lm_")), "lm")
        .when(F.startswith(tail, F.lit("combine")), "combine")
        .otherwise("mechanical")
    )


def language_of(language: Column, source: Column) -> Column:
    """The row's own language if it has one, else the source's."""
    return F.coalesce(
        truthy(language),
        F.when(source.isin(*V.RUST_SOURCES), "rust").when(source.isin(*V.PYTHON_SOURCES), "python"),
        F.lit("mixed"),
    )


def repo_of(repo: Column, instance_id: Column) -> Column:
    """The row's own repo if it has one, else the id up to its first dot."""
    return F.coalesce(truthy(repo), F.substring_index(instance_id, ".", 1))


def cold_pick(instance_id: Column) -> Column:
    """1 or 2: parity of the SHA-256 of the UTF-8 id, read off its last hex digit."""
    last = F.conv(F.substring(F.sha2(F.encode(instance_id, "UTF-8"), 256), -1, 1), 16, 10).cast("int")
    return (F.pmod(last, F.lit(2)) + 1).cast("int")


def turn_index_for(phase: str, first_edit: Column, pick: Column | None = None) -> Column:
    """0-based assistant turn to cut before.

    cold: the pick, 1 if it is neither 1 nor 2.  Else 1 without an edit; pre_edit: two
    turns before the first edit but at least 1; any other phase: the first edit.
    """
    if phase == "cold":
        return F.lit(1) if pick is None else F.when(pick.isin(1, 2), pick).otherwise(1)
    at = F.greatest(F.lit(1), first_edit - 2) if phase == "pre_edit" else first_edit
    return F.when(first_edit <= 0, 1).otherwise(at).cast("int")


def sample_id(shard: Column, row: Column, turn_idx: Column) -> Column:
    """`shard:row:turn`; null if a part is null."""
    return F.concat(shard, F.lit(":"), row.cast("string"), F.lit(":"), turn_idx.cast("string"))


def parse_shard(spec: str) -> tuple[int, int]:
    """(i, n) of `i/n`; ValueError unless n >= 1 and 0 <= i < n."""
    left, _, right = spec.partition("/")
    i, n = int(left), int(right)
    if n < 1 or not 0 <= i < n:
        raise ValueError(f"bad shard {spec!r}: want i/n with 0 <= i < n")
    return i, n
