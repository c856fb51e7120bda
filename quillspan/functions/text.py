"""Fenced commands, submit sentinels and observation envelopes, all as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan import fixed_values as V

# Java's \s is ASCII unless (?U); the four separators below U+0020 are white space too.
_BLANK = r"[\s\x1c-\x1f]"
SUBMIT_PATTERN = "(?U)" + V.SUBMIT
_FENCE = "(?s)" + V.COMMAND_FENCE


def strip_blank(text: Column) -> Column:
    """Text without white space at either end, in the Unicode sense; null stays null."""
    return F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def has_command(text: Column) -> Column:
    """True if a shell fence opens and closes in the text; an empty fence counts."""
    return F.coalesce(text, F.lit("")).rlike(_FENCE)


def first_command(text: Column) -> Column:
    """Body of the first shell fence, stripped; empty for null, no fence or an empty fence."""
    return strip_blank(F.regexp_extract(F.coalesce(text, F.lit("")), _FENCE, 1))


def unusable_reason(text: Column) -> Column:
    """`empty` for blank text, `no bash block` without a shell fence, else the empty string."""
    return F.when(is_blank(text), "empty").when(~has_command(text), "no bash block").otherwise("")


def is_submit(command: Column) -> Column:
    """True if a submit sentinel stands anywhere in the command, word-bounded and case-sensitive."""
    return F.coalesce(command, F.lit("")).rlike(SUBMIT_PATTERN)


def returncode_envelope(body: Column, returncode: int = 0) -> Column:
    """The four-line envelope around a command's output."""
    return F.concat(F.lit(f"<returncode>{returncode}</returncode>\n<output>\n"), body, F.lit("\n</output>"))


def stub_observation(command: Column) -> Column:
    """Envelope with the first characters of the command on one line, for runs without an environment."""
    flat = F.replace(command, F.lit("\n"), F.lit(" "))
    return returncode_envelope(F.concat(F.lit("(stub) ran: "), F.substring(flat, 1, V.OBSERVATION_CHARS)))
