"""Event predicates over one command or one turn's text.

Each takes a string column and gives a boolean that is never null: null and empty
texts are no event.  `(?U)` makes Java read \\s, \\w and \\b in the Unicode sense.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions.text import is_submit


EDIT_PATTERN = "(?U)" + V.EDIT
VERIFY_PATTERN = "(?iU)" + V.VERIFY
CLAIM_PATTERN = "(?iU)" + V.CLAIM
WIDE_SEARCH_PATTERN = "(?iU)" + V.WIDE_SEARCH
INFRA_PATTERN = "(?iU)" + V.INFRA


def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(text, F.lit("")).rlike(pattern)


def is_edit(text: Column) -> Column:
    """A source edit: in-place tools, patches, copies, or a redirect to a relative file."""
    return _found(text, EDIT_PATTERN)


def is_verify(command: Column) -> Column:
    """A check run; a command that also submits is none."""
    return _found(command, VERIFY_PATTERN) & ~is_submit(command)


def is_claim(command: Column) -> Column:
    """A reproduction run: the narrower list, submit or not."""
    return _found(command, CLAIM_PATTERN)


def is_wide_search(command: Column) -> Column:
    """The command starts with a search over the whole tree."""
    return _found(command, WIDE_SEARCH_PATTERN)


def is_infra(command: Column) -> Column:
    """Installing or looking for the test runner itself."""
    return _found(command, INFRA_PATTERN)
