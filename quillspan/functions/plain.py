"""The few text functions that policies need on single Python strings."""

from __future__ import annotations

import re

from quillspan import fixed_values as V

_FENCE = re.compile(V.COMMAND_FENCE, re.S)
_SUBMIT = re.compile(V.SUBMIT)


def first_command(text: str | None) -> str:
    found = _FENCE.search(text or "")
    return found.group(1).strip() if found else ""


def unusable_reason(text: str | None) -> str:
    if not (text or "").strip():
        return "empty"
    return "" if _FENCE.search(text) else "no bash block"


def is_submit(command: str | None) -> bool:
    return _SUBMIT.search(command or "") is not None
