"""A hand-written transcript: a stale cache entry is looked for, found and mended by the fourth command."""

COMMANDS = (
    "go test ./cache -run Expire",
    "ls -R cache",
    "awk 'NR>=40 && NR<=75' cache/expire.go",
    "perl -0pi -e 's/<= now/< now/' cache/expire.go && sed -i '3d' cache/notes.txt",
    "git diff --stat",
    "go test ./cache -count=3",
    "tail -n 5 cache/notes.txt",
)
TURNS = "array<struct<role:string,content:string>>"


def say(command, thought="look further"):
    return ("assistant", f"THOUGHT: {thought}\n\n```bash\n{command}\n```")


def turns(commands=COMMANDS):
    """The ticket, then each command with what it printed."""
    seen = ("user", "<returncode>0</returncode>\n<output>\ndone\n</output>")
    return [("user", "Entries are kept for a second too long."), *(t for c in commands for t in (say(c), seen))]
