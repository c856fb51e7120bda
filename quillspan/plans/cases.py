"""Built-in commands and rollouts on which every detector and every rule fires, and near misses of them."""

from __future__ import annotations

from typing import NamedTuple

COMMANDS = (
    None,
    "",
    "ls",
    "sed -i s/a/b/ f.py",
    "sed -n 1,5p f.py",
    "echo x 2>err",
    "echo x 2>>err",
    "echo x > out.txt",
    "echo x > /tmp/x",
    "cat f >/dev/null",
    "x->y",
    "python tool.py 'print(3 > 2)'",
    "git apply fix.diff",
    "patch -p1 < fix.diff",
    "pytest -q",
    "PYTEST",
    "python3 -c 'print(1)'",
    "python -m unittest",
    "nosetests tests",
    "rake test",
    "cargo test; echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT",
    "rake test && echo SUBMIT_TASK_0123ABCD",
    "echo FINALIZE_AND_SUBMIT_TASK_OUTPUT",
    "echo submit_task_0123abcd",
    "go  test ./...",
    "find . -name a",
    "find / -name a",
    "find src -name a",
    " grep -rn a .",
    "grep -n a f",
    "rg a .",
    "pip install pytest",
    "pip install -r pytest.txt",
    "python3 -m pip install -U pytest",
    "which pytest",
    "find / -name 'pytest'",
    "pip install numpy",
)


class Rollout(NamedTuple):
    sample_id: str
    rollout: int
    phase_wanted: str | None
    stopped: str
    messages: list[tuple[str, str]]
    continuation: list[tuple[str, str]]
    commands: list[str]


def _said(commands: tuple[str, ...]) -> list[tuple[str, str]]:
    return [t for c in commands for t in (("assistant", f"THOUGHT: on\n\n```bash\n{c}\n```"), ("user", "done"))]


def _rolled(i: int, phase: str | None, before: tuple[str, ...], commands: tuple[str, ...], stopped: str = "horizon") -> Rollout:
    tail = _said(commands)
    return Rollout(f"case{i // 2}", i % 2 + 1, phase, stopped, [("user", "a ticket"), *_said(before), *tail], tail, list(commands))


_EDIT, _TEST, _REST = "sed -i s/a/b/ f.py", "pytest -q", "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"
ROLLOUTS = tuple(
    _rolled(i, *case)
    for i, case in enumerate(
        (
            ("cold", (), (_TEST, _EDIT, _TEST, _REST), "submit"),
            ("cold", (), (_EDIT, _TEST)),
            ("cold", (), ("rake test", _EDIT, "rake test")),
            ("cold", (_TEST,), (_EDIT, "nosetests")),
            ("pre_edit", (), (_EDIT, "ls", _REST), "submit"),
            ("cold", (), ("ls",)),
            ("at_edit", (_EDIT,), ("ls",) * 4),
            ("at_edit", (), ("ls", "pwd", "ls", "pwd")),
            ("pre_edit", (), ("find . -name x", "grep -rn a .", "find . -type f")),
            ("at_edit", (), ("pip install pytest", "which pytest")),
            ("cold", (), ("python3 -m pip install pytest", "find / -name 'pytest'", _EDIT)),
            ("at_edit", (), ("pip install numpy", "which pytest")),
            ("at_edit", (_EDIT,), ("ls", _TEST)),
            (None, (), ("ls", _EDIT, _TEST)),
            ("at_edit", (), ("ls",), "bad_turn:empty"),
            ("cold", (), (_EDIT, f"{_TEST}; {_REST}"), "submit"),
        )
    )
)
