"""One form for shell commands that do the same: how a command is written down does not count.

Not counted are blanks, continued lines, quoting, a closing semicolon or comment, `./`
before and a slash after a path, the order of options before or between operands, bundled
or spelled-out options, and names made up for a single run (temporary paths, run tags).
Programs that are not listed keep their words in order.
"""

from __future__ import annotations

import re

import xxhash

# --- fixed values: options of common programs -------------------------------------------
# program: (short options that take a value, {long name: short name}, long options that take a value)
_GREP = {
    "recursive": "r",
    "dereference-recursive": "R",
    "line-number": "n",
    "ignore-case": "i",
    "count": "c",
    "max-count": "m",
    "files-with-matches": "l",
    "files-without-match": "L",
    "word-regexp": "w",
    "line-regexp": "x",
    "extended-regexp": "E",
    "fixed-strings": "F",
    "perl-regexp": "P",
    "invert-match": "v",
    "only-matching": "o",
    "no-filename": "h",
    "with-filename": "H",
    "quiet": "q",
    "silent": "q",
    "regexp": "e",
    "file": "f",
    "after-context": "A",
    "before-context": "B",
    "context": "C",
    "no-messages": "s",
    "text": "a",
    "null": "Z",
}
_HEAD = {"lines": "n", "bytes": "c", "quiet": "q", "silent": "q", "verbose": "v", "follow": "f"}
_GIT_LOG = {"max-count": "n", "patch": "p"}
OPTIONS: dict[str, tuple[str, dict[str, str], tuple[str, ...]]] = {
    "grep": ("efmABC", _GREP, ("include", "exclude", "exclude-dir", "color")),
    "egrep": ("efmABC", _GREP, ("include", "exclude", "exclude-dir", "color")),
    "rg": (
        "efmABCgtT",
        _GREP | {"glob": "g", "type": "t", "type-not": "T", "files-with-matches": "l", "smart-case": "S"},
        ("max-depth", "sort"),
    ),
    "wc": ("", {"lines": "l", "words": "w", "bytes": "c", "chars": "m", "max-line-length": "L"}, ()),
    "cat": (
        "",
        {
            "number": "n",
            "number-nonblank": "b",
            "show-all": "A",
            "show-ends": "E",
            "show-tabs": "T",
            "squeeze-blank": "s",
        },
        (),
    ),
    "ls": (
        "IwT",
        {
            "all": "a",
            "almost-all": "A",
            "recursive": "R",
            "reverse": "r",
            "human-readable": "h",
            "directory": "d",
            "size": "s",
            "inode": "i",
            "classify": "F",
            "no-group": "G",
        },
        ("sort", "time"),
    ),
    "head": ("nc", _HEAD, ()),
    "tail": ("ncs", _HEAD, ("pid",)),
    "sed": (
        "efl",
        {
            "quiet": "n",
            "silent": "n",
            "expression": "e",
            "file": "f",
            "regexp-extended": "E",
            "separate": "s",
            "null-data": "z",
            "unbuffered": "u",
        },
        (),
    ),
    "pytest": (
        "kmcpoWrn",
        {"quiet": "q", "exitfirst": "x", "verbose": "v", "showlocals": "l", "capture": "s", "last-failed": "lf"},
        ("tb", "maxfail", "durations", "basetemp", "rootdir", "junitxml", "ignore", "deselect", "cov", "timeout"),
    ),
    "mypy": ("cmp", {"module": "m", "package": "p", "command": "c", "verbose": "v"}, ("config-file",)),
    "diff": (
        "UCIW",
        {
            "unified": "U",
            "context": "C",
            "brief": "q",
            "recursive": "r",
            "ignore-case": "i",
            "ignore-all-space": "w",
            "new-file": "N",
        },
        (),
    ),
    "sort": (
        "kto",
        {"numeric-sort": "n", "reverse": "r", "unique": "u", "key": "k", "output": "o", "ignore-case": "f"},
        (),
    ),
    "uniq": ("fsw", {"count": "c", "repeated": "d", "unique": "u", "ignore-case": "i"}, ()),
    "cp": ("tS", {"recursive": "r", "force": "f", "verbose": "v", "archive": "a", "preserve": "p"}, ()),
    "mv": ("tS", {"force": "f", "verbose": "v", "no-clobber": "n"}, ()),
    "rm": ("", {"recursive": "r", "force": "f", "verbose": "v"}, ()),
    "mkdir": ("m", {"parents": "p", "mode": "m", "verbose": "v"}, ()),
    "touch": ("rtd", {"no-create": "c", "reference": "r", "date": "d"}, ()),
    "tree": ("LIP", {}, ()),
    "du": ("dBt", {"human-readable": "h", "summarize": "s", "all": "a", "max-depth": "d", "total": "c"}, ()),
    "git log": ("nSGL", _GIT_LOG, ("format", "pretty", "since", "until", "author", "grep")),
    "git show": ("n", _GIT_LOG, ("format", "pretty")),
    "git diff": ("USG", {"unified": "U", "patch": "p", "ignore-all-space": "w"}, ("diff-filter",)),
    "git status": ("", {"short": "s", "branch": "b"}, ()),
    "git apply": ("pC", {"verbose": "v", "reverse": "R"}, ("directory",)),
    "git add": ("", {"all": "A", "update": "u", "patch": "p", "force": "f", "verbose": "v"}, ()),
    "git commit": ("mFC", {"message": "m", "all": "a", "file": "F", "quiet": "q"}, ("author", "date")),
    "git checkout": ("bB", {"force": "f", "quiet": "q"}, ()),
    "git stash": ("m", {"message": "m"}, ()),
    "git blame": ("LC", {}, ()),
    "git grep": ("efmABC", _GREP, ()),
}
_COUNTED = frozenset({"head", "tail", "git log", "git show"})  # `-5` means `-n 5`
_PLAIN = re.compile(r"[^\s\\'\"#|&;<>]+")
_BREAKS = ("&&", "||", "|&", ";;", "|", ";", "&")
_REDIRECT = re.compile(r"\d*(?:>>|>\||>&|<<<|<>|<&|&>>|&>|>|<)(?:\d+|-)?")

_PATH = re.compile(r"[\w.@+~%=:,-]*(?:/[\w.@+~%=:,*?-]*)+")
_SCRIPT = re.compile(r"[sy]([/|#,]).*\1.*\1[a-zA-Z0-9]*")
_TEMP = re.compile(r"(?:^|[=:])(?:/private)?(?:/tmp|/var/tmp|/dev/shm|/var/folders)/|\$\{?TMP(?:DIR)?\b")
_MADE_UP = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{4,}|[0-9A-F]{4,}|(?=[A-Za-z0-9]*\d)[A-Za-z0-9]{6,}|\d{3,})(?![A-Za-z0-9])")
_TAG = re.compile(r"(?=.*\d)[0-9a-fA-F]{6,}(?:-[0-9a-fA-F]+)*|\d{4}-?\d\d-?\d\d[T_-]?[\d:.Z-]*|\d{5,}(?:\.\d+)?")
_ASSIGNMENT = re.compile(r"[A-Za-z_]\w*=")
_HEREDOC = re.compile(r"<<-?\s*(['\"]?)(\w+)\1")
_END = re.compile(r"(?:\s*;)+\s*\Z|\s+#[^'\"\n]*\Z")
_INVISIBLE = dict.fromkeys(map(ord, "​‌‍⁠﻿"))


def split_words(line: str) -> list[tuple[str, bool]]:
    """(word, is operator) of a command line; quotes are resolved, comments and continuations dropped."""
    out: list[tuple[str, bool]] = []
    word: list[str] | None = None
    i, n = 0, len(line)

    def flush() -> None:
        nonlocal word
        if word is not None:
            out.append(("".join(word), False))
            word = None

    while i < n:
        c = line[i]
        if (plain := _PLAIN.match(line, i)) and not (word is None and c.isdigit() and _REDIRECT.match(line, i)):
            word = word or []
            word.append(plain.group())
            i = plain.end()
        elif c == "\\" and i + 1 < n:
            nxt = line[i + 1]
            if nxt == "\n":
                flush()
            else:
                word = word or []
                word.append(nxt)
            i += 2
        elif c == "\n":
            flush()
            out.append((";", True))
            i += 1
        elif c.isspace():
            flush()
            i += 1
        elif c == "#" and word is None:
            end = line.find("\n", i)
            i = n if end < 0 else end
        elif c == "'":
            end = line.find("'", i + 1)
            end = n if end < 0 else end
            word = word or []
            body = line[i + 1 : end]
            word.append(body if "$" not in body and "`" not in body else "\x01" + body)
            i = end + 1
        elif c == '"':
            word = word or []
            i += 1
            while i < n and line[i] != '"':
                if line[i] == "\\" and i + 1 < n and line[i + 1] in '"\\$`\n':
                    i += 1
                    if line[i] != "\n":
                        word.append("\x01" + line[i] if line[i] in "$`" else line[i])
                else:
                    word.append(line[i])
                i += 1
            i += 1
        elif (hit := _REDIRECT.match(line, i)) and (word is None or not c.isdigit()):
            flush()
            out.append((hit.group(), True))
            i = hit.end()
        elif mark := next((b for b in _BREAKS if line.startswith(b, i)), None):
            flush()
            out.append((mark, True))
            i += len(mark)
        else:
            word = word or []
            word.append(c)
            i += 1
    flush()
    return out


def plain_word(word: str) -> str:
    """A word with made-up temporary names masked and a path in its shortest spelling."""
    if _TEMP.search(word):
        word = _MADE_UP.sub("*", word)
    if _PATH.fullmatch(word) and "://" not in word and not _SCRIPT.fullmatch(word):
        name, eq, path = word.partition("=") if word.startswith("-") else ("", "", word)
        path = re.sub(r"/(?:\.?/)+", "/", path)
        path = re.sub(r"^(?:\./)+(?=.)", "", path)
        if len(path) > 1:
            path = path.rstrip("/")
        word = name + eq + path
    return word


def _arguments(program: str, words: list[str]) -> list[str]:
    """Options, each with its value, in a fixed order, then the operands as they stand."""
    valued, names, long_valued = OPTIONS[program]
    short_valued = set(valued)
    options: list[tuple[str, str]] = []
    operands: list[str] = []
    i = 0
    while i < len(words):
        w = words[i]
        i += 1
        if w == "--":
            operands += [w, *words[i:]]
            break
        if w.startswith("--") and len(w) > 2:
            name, eq, value = w[2:].partition("=")
            short = names.get(name)
            if not eq and (name in long_valued or (short and short[0] in short_valued)) and i < len(words):
                value = words[i]
                i += 1
            options.append((f"-{short}" if short else f"--{name}", value))
        elif program in _COUNTED and re.fullmatch(r"-\d+", w):
            options.append(("-n", w[1:]))
        elif w.startswith("-") and len(w) > 1 and not (program == "sed" and w.startswith("-i")):
            for j, c in enumerate(w[1:], start=1):
                if c in short_valued:
                    value = w[j + 1 :].removeprefix("=")
                    if not value and i < len(words):
                        value = words[i]
                        i += 1
                    options.append((f"-{c}", value))
                    break
                options.append((f"-{c}", ""))
        elif program == "sed" and w.startswith("-i"):
            options.append(("-i", w[2:]))
        else:
            operands.append(w)
    options.sort(key=lambda o: o[0])
    flat = [f"{name}\x02{plain_word(value)}" for name, value in options]
    flags = list(dict.fromkeys(flat))  # a repeated option says nothing new, except -v
    if any(f.startswith("-v\x02") for f in flat):
        flags = flat
    return flags + [plain_word(w) for w in operands]


def _simple(words: list[str]) -> list[str]:
    out: list[str] = []
    k = 0
    while k < len(words) and (m := _ASSIGNMENT.match(words[k])):
        value = words[k][m.end() :]
        out.append(m.group() + ("*" if _TAG.fullmatch(value) else plain_word(value)))
        k += 1
    out.sort()
    words = words[k:]
    if not words:
        return out
    program, rest = words[0], words[1:]
    if program.startswith("./") or "//" in program:
        program = plain_word(program)
    name = program
    if program == "git" and rest and not rest[0].startswith("-"):
        name, rest = f"git {rest[0]}", rest[1:]
    if name in OPTIONS:
        return [*out, name, *_arguments(name, rest)]
    return [*out, name, *map(plain_word, rest)]


def canonical(command: str | None) -> str | None:
    """The form that commands which do the same share; null for null and blank commands.

    A text that cannot be read as a command line is its own form without the blanks around it.
    """
    text = (command or "").translate(_INVISIBLE).replace("\r\n", "\n").strip()
    # a line continued inside a comment is read as the comment going on
    doc = _HEREDOC.search(text)
    edge = doc.start() if doc else len(text)
    text = text[:edge].replace("\\\n", " ") + text[edge:]
    while (shorter := _END.sub("", text)) != text:
        text = shorter
    text = text.strip()
    if not text:
        return None if not (command or "").translate(_INVISIBLE).strip() else (command or "").strip()
    body = ""
    if (doc := _HEREDOC.search(text)) and "\n" in text[doc.end() :]:
        head, _, body = text[doc.end() :].partition("\n")
        text = f"{text[: doc.start()]} \x03 {head}"
        lines = body.split("\n")
        while lines and lines[-1].strip(" \t\xa0;") in ("", doc.group(2)):
            lines.pop()
        body = "\n".join(line.rstrip() for line in lines)
    parts: list[str] = []
    words: list[str] = []
    after_redirect = False
    for word, operator in split_words(text):
        if operator and word in _BREAKS:
            parts += [*_simple(words), word]
            words = []
        elif operator:
            words.append(word)
            after_redirect = True
            continue
        else:
            words.append(plain_word(word) if after_redirect else word)
        after_redirect = False
    parts += _simple(words)
    while parts and parts[-1] == ";":
        parts.pop()
    return "\x00".join(parts) + ("\x03" + body if body else "")


_digests: dict[str, bytes | None] = {}


def form_digest(command: str | None) -> bytes | None:
    """128 bits of the canonical form; null for null and blank commands."""
    form = canonical(command)
    return None if form is None else xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass"))


def cached_digest(command: str | None, entries: int = 200_000) -> bytes | None:
    """`form_digest`, remembering short commands of this process up to a bound."""
    if command is None or len(command) > 4000:
        return form_digest(command)
    try:
        return _digests[command]
    except KeyError:
        if len(_digests) >= entries:
            _digests.clear()
        digest = _digests[command] = form_digest(command)
        return digest
