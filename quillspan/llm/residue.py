"""Problem 8: template residue, filler, error pages and script notices in place of content.

Lines outside code, command output and logs are scored by a regularised linear classifier
on hashed n-grams, length and title features.  It is trained on weak labels (response
statuses and phrases), and its threshold is set on hosts the scored weights have not seen.
The classifier alone decides which lines are residue; the phrase lists only label what it
is trained on, and name the kind of what it has found.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from http import HTTPStatus

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspan.llm.languages import FUNCTION_WORDS
from quillspan.session import cut_lineage, spread

TRAIN_DOCS = 10_000
TRAIN_POSITIVE = 10_000
TRAIN_NEGATIVE = 20_000
TABLE_BITS = 17
ORDERS = (4, 7)
RIDGE = 3e-6
POSITIVE_WEIGHT = 0.3  # of all labelled lines together
FOLDS = 2  # parts of the hosts for the threshold
PIECE_BYTES = 250_000
LEAST_BYTES = 12  # a shorter piece without a mark says too little to be judged
LONG = 400

# --- fixed values: what error pages, notices, forms and placeholders look like -------------
_STATUS = (
    r"(?:HTTP/\d(?:\.\d)? )?(?:error:? )?(?:4\d\d|5\d\d)[ :.-]+(?:not found|forbidden|unauthorized|bad (?:gateway|request)|"
    r"internal server error|service (?:temporarily )?unavailable|gateway time-?out|too many requests|gone|"
    r"access denied|method not allowed|request time-?out|payment required|conflict)[.!]?$"
)
ERROR_LINES = (
    _STATUS,
    r"(?:<[^>]*>\s*)*<title>\s*(?:error\s*)?[45]\d\d\b",
    r"(?:<\?xml[^>]*>\s*)?<error>\s*<code>",
    r"\{\s*\"(?:status|code|error|statuscode)\"\s*:\s*(?:[45]\d\d|\"[^\"]*(?:error|not|denied|unavailable))",
    r"(?:error|erreur|fehler|erro|ошибка|错误)[ :#]*[45]\d\d\b",
    r"oops[!,. ]",
    r"(?:sorry, )?(?:something|anything) went wrong\b",
    r"an (?:unexpected |unknown |internal )?error (?:has )?occurr?ed\b",
    r"(?:access|permission) (?:was |is )?denied\b",
    r"you (?:do not|don['’]t) have (?:permission|access)\b",
    r"your session (?:has |is )?(?:expired|timed out)\b",
    r"(?:request|access|connection) (?:was |is |has been )?(?:blocked|rejected|refused|reset)\b",
    r"too many (?:requests|attempts)\b",
    r"(?:we|i) (?:could not|couldn['’]t|can['’]?t|cannot) find (?:what|the|that|this)\b",
    r"(?:the|this) (?:requested )?(?:page|document|url|file|resource|address|repository|site|service|content)\b[^.]{0,80}"
    r"\b(?:not (?:be )?(?:found|located|available|reached|displayed|exist)|no longer|does not exist|unavailable|been (?:moved|removed|deleted)|cannot be)\b",
    r"(?:page|document|file|resource|content) (?:was |is |could )?(?:not (?:be )?(?:found|located|available|displayed)|unavailable)\b",
    r"this (?:repository|site|service|page) is (?:temporarily |currently )?(?:unavailable|down|offline|closed)\b",
    r"(?:service|site|server) (?:is )?(?:temporarily )?(?:unavailable|down|overloaded)\b",
    r"upstream (?:connect|request|server)\b[^.]{0,40}\b(?:error|timed? ?out|reset|failure)",
    r"certificate (?:problem|error|expired|verification)\b",
    r"gateway time-?out\b|bad gateway\b|internal server error\b",
    r"(?:la )?página (?:solicitada |pedida |que busca )?no (?:existe|se encuentra|está)|página no encontrada",
    r"esta página (?:está|não|no)\b[^.]{0,40}(?:indispon|existe|encontrad|disponible)|página não encontrada",
    r"(?:die )?seite (?:wurde )?nicht (?:gefunden|verfügbar|erreichbar)|diese seite (?:ist|existiert|wurde)\b",
    r"erreur \d+|page (?:introuvable|non trouvée)|vous n['’]avez pas (?:accès|l['’]autorisation)|(?:cette|la) page (?:n['’]existe|est (?:introuvable|indisponible))",
    r"страница (?:не найдена|недоступна|удалена)|доступ (?:запрещ[её]н|закрыт)|сервис (?:временно )?недоступен",
    r"(?:抱歉|对不起)?[，, ]*(?:您|你)?(?:访问|请求|查找)的(?:页面|内容|网页|资源)|页面(?:不存在|未找到|无法)|(?:服务器|系统)(?:错误|繁忙|维护)|访问被拒绝|没有权限",
)
NOTICE_LINES = (
    r"(?:<noscript>\s*)?(?:please |you (?:need|have) to |you must |turn on |enable |activate )[^.]{0,40}\b(?:java\s?script|scripts)\b",
    r"(?:this|our|the) (?:application|app|page|site|tracker|website|content|discussion)\b[^.]{0,80}\b(?:java\s?script|scripts?)\b",
    r"java\s?script (?:is|must be|has to be|appears to be)\b[^.]{0,30}\b(?:off|disabled|required|enabled|needed|turned|available)",
    r"<noscript>",
    r"content cannot be displayed\b",
    r"loading\.*\s*(?:if nothing appears|please wait|javascript)",
    r"checking (?:that |if )?(?:your|the) (?:browser|connection)\b",
    r"(?:scripts|java\s?script|cookies) (?:are|is) (?:required|disabled|blocked|needed|turned off)\b",
    r"(?:bitte )?(?:aktivieren|schalten) sie\b[^.]{0,20}\bjava\s?script|java\s?script (?:ist|muss)\b",
    r"(?:veuillez )?activer java\s?script|veuillez activer\b|java\s?script (?:est|doit)\b",
    r"(?:por favor,? )?(?:active|activa|habilite|habilita)(?: el)? java\s?script|java\s?script (?:está|debe)\b",
    r"(?:por favor,? )?(?:ative|ativa|habilite)(?: o)? java\s?script|java\s?script (?:está|deve)\b",
    r"для (?:просмотра|работы|отображения)\b[^.]{0,40}\bjava\s?script|(?:пожалуйста, )?включите java\s?script",
    r"请(?:先)?(?:启用|开启|打开|允许)\s*(?:java\s?script|脚本)|(?:需要|必须)(?:启用)?\s*java\s?script",
)
FORM_LINES = (
    r"\((?:one|two|a few|a couple|1|2)(?: or (?:two|three|more|2|3))? (?:sentences?|lines?|words?)[^)]*\)$",
    r"\((?:commands?|steps?|tests?|links?|screenshots?|logs?) (?:you|that you|here)[^)]*\)$",
    r"(?:please )?(?:attach|paste|insert|add|put|enter|upload) (?:the |your |any )?(?:relevant )?(?:logs?|screenshots?|output|details|text|files?|stack ?traces?) (?:here|below)[.!]?$",
    r"(?:please )?(?:tell us|describe|explain|summari[sz]e)\b[^.]{0,30}\b(?:in (?:one|two|a few|your own)\b[^.]{0,40}(?:sentences?|words?|lines?)|here|below)",
    r"[\w ]{2,20}: \w+(?: / \w+)+$",
    r"(?:what|the (?:outcome|result|behaviou?r|thing|page|error|message)) (?:that )?you (?:had in mind|expected|saw|wanted|did|were doing)[.]?$",
    r"(?:\d+[.)] )?(?:open|type|notice|click|go to|see|run|scroll(?: down)? to|enter) \.\.\.$",
    r"[-*] (?:added|changed|fixed|removed|deprecated|security): \.\.\.$",
    r"(?:release|version)? ?v?x\.y(?:\.z)?$",
    r"(?:todo|tbd|fixme)[ :]+(?:write|add|fill|replace|describe|insert|complete)\b",
)
_NAME = r"[^\W\d][\w .-]{0,40}"
PLACEHOLDERS = (
    rf"\{{\{{\s*{_NAME}\s*\}}\}}",
    r"(?<![\w$#%{(\[\"'])\{[a-z_][\w.]{1,40}\}(?![}\w])",
    rf"[$#]\{{{_NAME}\}}",
    r"(?<![\w%])%[A-Za-z_][\w.]{1,40}%(?![\w%])",
    r"%\([\w. ]{1,40}\)[sdrf]\b",
    r"(?<![\w$])\$[A-Za-z_][\w.]{1,40}\$(?![\w$])",
    rf"\[\[\s*{_NAME}\s*\]\]",
    rf"@@\s*{_NAME}\s*@@",
    r"(?<!\w)__[A-Z][A-Z_ ]{1,40}__(?!\w)",
    r"<(?:your|add|insert|enter|fill in|put|replace|describe|the) [\w .-]{1,40}>",
    r"<[\w .-]{1,40} (?:goes )?here>",
    r"&lt;\s*[\w .-]{1,40}\s*&gt;",
    r"\[(?:insert|add|enter|your|fill in|put|replace|describe|todo|tbd)\b[^\]\n]{0,60}\]",
    r"\[[^\]\n]{1,50} (?:eintragen|einfügen|ergänzen|angeben|goes here|here|hier|aquí|aqui|ici|à compléter|à remplir|"
    r"por completar|a preencher|вставить|указать)\]",
    r"\[(?:insérer|indiquer|ajouter|insertar|indicar|añadir|rellenar|inserir|preencher|adicionar|вставить|вставьте|указать|укажите|"
    r"填写|插入|请填写|在此)[^\]\n]{0,60}\]",
    r"\*{2,}[^*\n]{0,60}\bto be (?:added|filled(?: in)?|done|defined|decided|confirmed|completed|written)\b[^*\n]{0,20}\*{2,}",
    r"\((?:fill in|please fill|insert|enter) [^)\n]{1,50}\)",
    r"\{%-?\s*\w+[^%\n]{0,60}%\}",
    r"<!--\s*(?:describe|add|insert|fill|your|replace|write|explain|please|put|enter|list|summari[sz]e|provide|delete|remove)\b[^>]{0,200}-->",
    r"<%[=-]?[^%\n]{1,60}%>",
)
NAVIGATION = (
    r"skip to (?:main )?content",
    r"menu|search",
    r"home(?: \| [\w ]+){1,6}",
    r"about\s+terms\s+privacy(?:\s+\w+)*",
    r"(?:[←«‹<]+ ?)?(?:go )?back to [\w ]+",
    r"[\w.-]+ - [\w-]+(?:\.[\w-]+)+",
)
SEED_LINES = (
    "The requested page could not be found on this server.",
    "The requested URL was not found on this server.",
    "The page you are looking for does not exist.",
    "The page you were looking for may have moved or been deleted.",
    "Sorry, the page you are looking for is currently unavailable. Please try again later.",
    "Sorry, this page is not available right now.",
    "We are sorry, but something went wrong.",
    "Something went wrong. Please reload the page.",
    "The server encountered an internal error and was unable to complete your request.",
    "The server is temporarily unable to service your request. Please try again later.",
    "The upstream server is taking too long to respond.",
    "The proxy server received an invalid response from an upstream server.",
    "You do not have permission to access this page.",
    "Access to this page has been denied.",
    "Please verify that you are a human.",
    "Your session has expired. Please sign in again.",
    "You must sign in to view this page.",
    "If the problem persists, please contact the administrator.",
    "This site is down for maintenance.",
    "JavaScript is disabled in your browser. Please enable JavaScript to continue.",
    "This page requires JavaScript.",
    "You need to enable JavaScript to run this app.",
    "Please turn JavaScript on and reload the page.",
    "Enable JavaScript and cookies to continue",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "lorem ipsum lorem ipsum lorem ipsum",
    "test test test test test",
    "blah blah blah blah blah",
    "asdf asdf asdf qwer asdf",
    "Coming soon",
    "TODO: write this section",
    "To be added",
)
SEED_NAMES = ("name", "title", "date", "version", "your name", "user_name", "description")
SEED_MARKS = (
    ("{{", "}}"), ("{{ ", " }}"), ("{", "}"), ("${", "}"), ("<", ">"), ("<your ", ">"), ("[", "]"), ("[insert ", " here]"),
    ("[[", "]]"), ("%", "%"), ("$", "$"), ("@@", "@@"), ("__", "__"), ("(fill in ", ")"), ("<!-- add the ", " -->"), ("Dear {{", "}},"),
)
KEYBOARD_ROWS = ("qwertyuiop", "asdfghjkl;", "zxcvbnm")
NEUTRAL_WORDS = frozenset("test tests testing foo bar baz qux abc aaa xxx yyy zzz lorem ipsum blah".split())

_I = re.I
_ERROR = re.compile("|".join(f"(?:{p})" for p in ERROR_LINES), _I)
_NOTICE = re.compile("|".join(f"(?:{p})" for p in NOTICE_LINES), _I)
_FORM = re.compile("|".join(f"(?:{p})" for p in FORM_LINES), _I)
_HOLE = re.compile("|".join(f"(?:{p})" for p in PLACEHOLDERS), _I)
_NAVIGATION = re.compile("|".join(f"(?:{p})" for p in NAVIGATION), _I)
# code and command output; blanks within a fence are damage, an open fence ends with its paragraph
_CODE = re.compile(
    r"`[ \t]{0,3}`[ \t]{0,3}`.*?(?:`[ \t]{0,3}`[ \t]{0,3}`|\n[ \t]*\n|\Z)|<output>.*?(?:</output>|\Z)|</output>|<(script|style)\b.*?</\1>", re.S | _I
)
_INLINE = re.compile(r"`[^`\n]*`|(?<![\w])[\"“][^\"”\n]{1,200}[\"”]|'[^'\n]{1,80}'(?!\w)")
_INLINE_CODE = re.compile(r"`[^`\n]+`")
_INVISIBLE = re.compile("[​‌‍⁠﻿­]")
_LOG = re.compile(
    r"\s*(?:\[?\d{4}-\d\d-\d\d[T ])?\[?\d\d:\d\d:\d\d\b|\s*\[?(?:INFO|WARN(?:ING)?|ERROR|DEBUG|TRACE|FATAL)\]?[ :]\s*\S|\s*(?:>>>|\$ |\+ )"
)
_SENTENCES = re.compile(r"(?<=[.!?。！？])\s*(?<![.][.])(?=\S)(?<=[\s。！？])").split
_MARK = re.compile(r"[{}<>\[\]%$@#*(&]|__")
_MARKED = re.compile(r"(\S?[{<\[(%$@#*]+[^{}<>\[\]()%$@#*]{1,60}[}>\])%$@#*]+\S?|\S?\b__\w+__\b\S?|&lt;[^&]{1,60}&gt;)").split
_BLOCK = re.compile(r"(?=<(?:title|body|main|section|div|p|h\d|li|td|noscript)\b)", _I).split
_SPEAKER = re.compile(r"^\s*(?:user|assistant|system|tool)\s*:\s*", _I)
_WRAP = re.compile(r"^(?:\s|<(?:div|p|span|section|main|body|center|h\d|b|strong|em)\b[^>]*>|#+\s|>+\s?|\*\*|[-*•]\s)+", _I)
_TAIL = re.compile(r"(?:\s|</(?:div|p|span|section|main|body|center|h\d|b|strong|em)>|\*\*)+$", _I)
_ZERO_WIDTH = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
_IDENTIFIER = re.compile(r"\b\w+_\w+\b|\b\w+/\w+|\b[A-Z][a-z]+[A-Z]\w*|\b\w+\.\w+\(")
_WORD = re.compile(r"[^\W\d_]+;?")
_FUNCTION = frozenset(w for ws in FUNCTION_WORDS.values() for w in ws.split() if len(w) > 1) - frozenset(
    "sed et in ut ad non si me te se ne per an as at nec est sit amet dolor ante nunc nulla mira calor tempo".split()
)


def content_lines(text: str) -> list[str]:
    """Lines of a text without code and command output; of code within a line its two marks are left."""
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
    if "`" in text or "<" in text:
        text = _CODE.sub("\n", text)
        text = _INLINE_CODE.sub("``", text)
    return [line for line in text.split("\n") if line and not line.isspace()]


def segments(line: str) -> list[str]:
    """What the classifier sees of a line: itself, or its sentences if it is long.

    What stands between marks such as brackets is a piece of its own in a long sentence.
    """
    if len(line) <= 120:
        return [line]
    out = []
    for sentence in _SENTENCES(line):
        if len(sentence) > 60 and _MARK.search(sentence):
            out += [x for x in _MARKED(sentence) if x and not x.isspace()]
        elif sentence:
            out.append(sentence)
    return out


def bare(line: str) -> str:
    """A line without invisible characters, speaker, markup around it and navigation words."""
    line = _SPEAKER.sub("", line.translate(_ZERO_WIDTH))
    return _TAIL.sub("", _WRAP.sub("", line)).strip()


def is_filler(line: str) -> bool:
    """Repeated words or phrases, keyboard rows, one letter over and over, or words of no language."""
    words = [w.lower() for w in _WORD.findall(line)]
    n = len(words)
    if n == 1:
        return re.fullmatch(r"([^\W\d_])\1{9,}", words[0]) is not None and len(line) < len(words[0]) + 4
    if n < 4:
        return False
    kinds = set(words)
    if len(kinds) == 1 and len(words[0]) > 1:
        return True
    if n >= 5 and len(kinds) <= 2 and max(map(words.count, kinds)) >= n - 1:
        return True
    if n >= 6 and len(kinds) <= 8 and len(kinds) <= 0.34 * n and not _IDENTIFIER.search(line):
        return True
    rows = sum(_on_keyboard(w) for w in kinds)
    if n >= 4 and rows >= 2 and all(_on_keyboard(w) or w in NEUTRAL_WORDS for w in kinds):
        return True
    if n >= 6 and line.isascii() and not _IDENTIFIER.search(line) and not re.search(r"\d", line):
        return not any(w in _FUNCTION for w in words) and max(map(len, words)) <= 14 and n >= len(line) / 9
    return False


def _on_keyboard(word: str) -> bool:
    return len(word) >= 3 and any(word in row or word[::-1] in row for row in KEYBOARD_ROWS)


def kind_of(line: str) -> str | None:
    """What stands on the line in place of content: placeholder, form, error, notice or filler."""
    if _LOG.match(line):
        return None
    own = bare(line)
    if not own:
        return None
    if _ERROR.match(own) and not _speaks_about(own):
        return "error"
    if _NOTICE.match(own) and not _speaks_about(own):
        return "notice"
    if _FORM.match(own):
        return "form"
    if _MARK.search(line) and _HOLE.search(_INLINE.sub(" ", line.translate(_ZERO_WIDTH))):
        return "placeholder"
    if is_filler(_INLINE.sub(" ", own)):
        return "filler"
    return None


def kind_within(line: str) -> str | None:
    """`kind_of` of the first block that has one: pages on one line have a tag before each block."""
    return next(filter(None, map(kind_of, _BLOCK(line))), None)


def _speaks_about(line: str) -> bool:
    """A sentence about a message: with several identifiers."""
    return len(_IDENTIFIER.findall(re.sub(r"<[^>]*>|\{[^}]*\}", " ", line))) > 1


# --- the classifier -------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[48:58] = 48  # digits alike
_LENGTHS = (0, 8, 20, 40, 80, 160, 320, 640)
_FLAGS = 5
_EXTRA = len(_LENGTHS) + _FLAGS


@dataclass(frozen=True)
class LineModel:
    """Weights of the hashed n-grams and of the other features, intercept and threshold of the score."""

    grams: np.ndarray
    extra: np.ndarray
    bias: float
    threshold: float = 0.0

    def scores(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Log odds of each piece of `buffer`: n-gram weights summed over the root of their number."""
        total = np.zeros(len(starts))
        count = np.zeros(len(starts))
        for order, slots in _grams(buffer):
            sums = np.empty(len(slots) + 1, dtype=np.float64)
            sums[0] = 0
            np.cumsum(self.grams[slots], dtype=np.float64, out=sums[1:])
            last = np.clip(ends - order + 1, starts, len(slots))
            total += sums[last] - sums[np.minimum(starts, len(slots))]
            count += last - starts
        return total / np.sqrt(np.maximum(count, 1)) + extra @ self.extra + self.bias


NOTHING = LineModel(np.zeros(1 << TABLE_BITS, dtype=np.float32), np.zeros(_EXTRA), 0.0, np.inf)


def _grams(buffer: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, table slot of the n-gram at each byte) of lower-cased bytes."""
    for order in ORDERS:
        n = len(buffer) - order + 1
        if n <= 0:
            yield order, np.zeros(0, dtype=np.uint32)
            continue
        h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for i in range(order):
            h *= np.uint32(0x01000193)
            h ^= buffer[i : i + n]
        h *= np.uint32(0x85EBCA6B)
        h >>= np.uint32(32 - TABLE_BITS)
        yield order, h


def _features(sizes: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Length class (one of eight) and title features of each piece."""
    out = np.zeros((len(sizes), _EXTRA), dtype=np.float32)
    out[np.arange(len(sizes)), np.searchsorted(_LENGTHS, sizes, side="right") - 1] = 1
    out[:, len(_LENGTHS) :] = flags
    return out


def _flags(lines: list[str]) -> list[tuple[bool, bool, bool, bool, bool]]:
    """Title features: first line, last line, few lines, below navigation or a section title, looks like a title."""
    n, few, out, below = len(lines), len(lines) <= 8, [], False
    for i, line in enumerate(lines):
        title = line.startswith("#")
        out.append((i == 0, i == n - 1, few, below, title))
        below = len(line) < 60 and (title or line.endswith(":") or _NAVIGATION.fullmatch(line.strip()) is not None)
    return out


def _encoded(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all pieces with a line feed before and after each, start and end of each, both line feeds included)."""
    raw = [piece.encode() for piece in pieces]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    ends = np.cumsum(sizes + 1) + 1
    buffer = _LOWER[np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", dtype=np.uint8)]
    return buffer, ends - sizes - 2, ends


def fit(
    pieces: list[str], flags: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 60, ridge: float = RIDGE
) -> LineModel:
    """Logistic regression by Adam steps over all pieces, with an L2 penalty.

    `weights` are relative within a label; the positives together weigh `POSITIVE_WEIGHT`
    of all.  The penalty is `ridge` times half the squared weights of n-grams.
    """
    buffer, starts, ends = _encoded(pieces)
    extra = _features(ends - starts - 2, flags).astype(np.float64)
    slot, sizes = [], []
    for order, slots in _grams(buffer):
        n = np.clip(ends - order + 1, starts, len(slots)) - starts
        slot.append(slots[np.repeat(starts - np.cumsum(n) + n, n) + np.arange(int(n.sum()))])
        sizes.append(n)
    some = [np.flatnonzero(n) for n in sizes]
    first = [(np.cumsum(n) - n)[i] for n, i in zip(sizes, some, strict=True)]
    norm = 1 / np.sqrt(np.maximum(sum(sizes), 1))
    line = np.concatenate([np.repeat(np.arange(len(pieces)), n) for n in sizes])
    # n-grams in the order of their slots, for the gradients
    flat = np.concatenate(slot)
    by_slot = np.argsort(flat)
    line_of, ordered = line[by_slot], flat[by_slot]
    slot_at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    slots_seen = ordered[slot_at]
    place = np.zeros(1 << TABLE_BITS, dtype=np.intp)
    place[slots_seen] = np.arange(len(slots_seen))
    slot = [place[x] for x in slot]
    y = labels.astype(np.float64)
    share = np.where(labels, POSITIVE_WEIGHT, 1 - POSITIVE_WEIGHT)
    weight = weights * share / np.where(labels, weights[labels].sum(), weights[~labels].sum())
    size = len(slots_seen)
    theta = np.zeros(size + _EXTRA + 1)
    rate = np.concatenate((np.full(size, 2.0), np.full(_EXTRA + 1, 0.1)))
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, e, b = theta[:size], theta[size:-1], theta[-1]
        z = extra @ e + b
        narrow = w.astype(np.float32)
        for own, rows, at in zip(slot, some, first, strict=True):
            if len(rows):
                z[rows] += np.add.reduceat(narrow[own], at) * norm[rows]
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gw = np.add.reduceat((g * norm).astype(np.float32)[line_of], slot_at) + ridge * w
        grad = np.concatenate((gw, g @ extra, [g.sum()]))
        one = 0.9 * one + 0.1 * grad
        two = 0.99 * two + 0.01 * grad * grad
        theta = theta - rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-12)
    grams = np.zeros(1 << TABLE_BITS, dtype=np.float32)
    grams[slots_seen] = theta[:size]
    return LineModel(grams, theta[size:-1].copy(), float(theta[-1]))


@dataclass(frozen=True)
class Sample:
    """Labelled pieces of sampled documents: what they are, where they stood, and how many pieces each stands for.

    The host is null if a piece stood on several: whatever hosts are left out, it has been seen.
    """

    pieces: list[str]
    flags: np.ndarray
    labels: np.ndarray
    hosts: list[str | None]
    counts: np.ndarray

    def part(self, rows: np.ndarray) -> Sample:
        at = np.flatnonzero(rows)
        return Sample(
            [self.pieces[i] for i in at], self.flags[at], self.labels[at], [self.hosts[i] for i in at], self.counts[at]
        )

    def both_labels(self) -> bool:
        return bool(self.labels.any() and not self.labels.all())

    def fold(self, of: int) -> np.ndarray:
        """Which of `of` parts each piece's host falls into, -1 for those of several hosts."""
        return np.array([-1 if h is None else zlib.crc32(h.encode()) % of for h in self.hosts], dtype=np.int64)

    def fitted(self) -> LineModel:
        return fit(self.pieces, self.flags, self.labels, np.sqrt(self.counts))

    def scored(self, model: LineModel) -> np.ndarray:
        buffer, starts, ends = _encoded(self.pieces)
        return model.scores(buffer, starts, ends, _features(ends - starts - 2, self.flags))


def labelled_pieces(lines: list[str]) -> Iterator[tuple[str, tuple, bool]]:
    """(piece, title features, weak label) of the lines of one text."""
    for line, flag in zip(lines, _flags(lines), strict=True):
        parts = segments(line)
        whole = kind_of(line) is not None
        if not whole and len(line) <= LONG:
            marks = [False] * len(parts)
        elif len(parts) == 1:
            marks = [whole or kind_within(line) is not None]
        else:
            marks = [(kind_within(x) if len(line) > LONG else kind_of(x)) is not None for x in parts]
            if whole and not any(marks):
                marks = [True] * len(parts)
        yield from ((x, flag, m) for x, m in zip(parts, marks, strict=True))


def seed_pieces() -> list[str]:
    """Weakly labelled positives that need no corpus: response statuses in usual notations, and `SEED_LINES`."""
    out = list(SEED_LINES)
    for status in HTTPStatus:
        if status.value >= 400:
            out += [f"{status.value} {status.phrase}", f"Error {status.value}: {status.phrase}", f"{status.phrase}."]
            out += [f"{status.value} {status.phrase}. {status.description}."] if status.description else []
    return out + [f"{left}{name}{right}" for left, right in SEED_MARKS for name in SEED_NAMES]


def hash_bound(share: float) -> int:
    """The 64-bit hash up to which a share of all hashes lies; shares of a million million keys still differ."""
    return min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))


def sample_lines(
    df: DataFrame,
    key: str,
    text: str,
    host: str,
    docs: int = TRAIN_DOCS,
    positive: int = TRAIN_POSITIVE,
    negative: int = TRAIN_NEGATIVE,
) -> Sample:
    """Weakly labelled pieces of a bounded sample of documents, and the seeds.

    About `docs` documents are chosen by a 64-bit hash of the key (any number of them can be
    told apart by it); of their distinct pieces at most `positive` weak positives and, drawn
    apart from them, at most `negative` others come to the driver, frequent ones more likely.
    """
    share = min(1.0, docs / max(1, df.count()))
    chosen = df.where(F.xxhash64(F.lit("residue"), key) <= F.lit(hash_bound(share))).select(host, text)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for own_host, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(own_host or "", *x) for x in labelled_pieces(content_lines(body or ""))]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.list_(pa.bool_()), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "piece", "flags", "label"]
            )

    pieces = spread(chosen).mapInArrow(label, "host string, piece string, flags array<boolean>, label boolean")
    # navigation and the like repeat in every page: one of each (piece, label) is enough to learn from
    distinct = pieces.groupBy("piece", "label").agg(
        F.when(F.min("host") == F.max("host"), F.min("host")).alias("host"),
        F.min("flags").alias("flags"),
        F.count(F.lit(1)).alias("n"),
    )
    distinct = cut_lineage(distinct)
    unit = (F.shiftrightunsigned(F.xxhash64("piece"), 11).cast("double") + 1) / F.lit(float(1 << 53))
    drawn = []
    for mark, most in ((True, positive), (False, negative)):
        own = distinct.where(F.col("label") == mark).withColumn("at", -F.log(unit) / F.col("n"))
        rows = own.orderBy("at", "piece").limit(most + 1).toPandas()
        if len(rows) > most:  # a piece was drawn with the probability that its place lies before the first one left out
            rows["n"] = rows["n"] / -np.expm1(-rows["n"] * rows["at"].iloc[most])
        drawn.append(rows.head(most))
    rows = pd.concat(drawn, ignore_index=True)
    seeds = seed_pieces()
    places = ((True, True, True, False, False), (False, False, False, True, False))
    flags = rows["flags"].tolist() + [places[i % 2] for i in range(len(seeds))]
    return Sample(
        rows["piece"].tolist() + seeds,
        np.array(flags, dtype=np.float32).reshape(-1, _FLAGS),
        np.array(rows["label"].tolist() + [True] * len(seeds), dtype=bool),
        rows["host"].tolist() + seeds,
        np.array(rows["n"].tolist() + [1.0] * len(seeds)),
    )


def threshold_of(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The score that parts the labels with the best F1 of all, halfway between its neighbours; 0 without positives."""
    if not labels.any():
        return 0.0
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(np.where(labels, counts, 0)[order])
    at = int(np.argmax(2 * hits / (np.cumsum(counts[order]) + counts[labels].sum())))
    below = scores[order[at + 1]] if at + 1 < len(order) else scores[order[at]] - 1
    return float((scores[order[at]] + below) / 2)


def _trained(sample: Sample) -> LineModel:
    """The model of a sample; its threshold is set on scores of hosts by weights of the other hosts, in `FOLDS` parts."""
    part = sample.fold(FOLDS)
    scores = np.full(len(part), np.nan)
    for own in range(FOLDS):
        others, rows = sample.part(part != own), (part == own) | ((part == -1) & (own == 0))
        if others.both_labels() and rows.any():
            scores[rows] = sample.part(rows).scored(others.fitted())
    known = ~np.isnan(scores)
    threshold = threshold_of(scores[known], sample.labels[known], sample.counts[known])
    return replace(sample.fitted(), threshold=threshold)


def train(df: DataFrame, key: str, text: str, host: str) -> LineModel:
    """The model of the sampled lines; of a corpus without lines, one that finds nothing."""
    sample = sample_lines(df, key, text, host)
    return _trained(sample) if sample.both_labels() else NOTHING


def validate(df: DataFrame, key: str, text: str, host: str) -> dict[str, float]:
    """Precision and recall, against weak labels, on one host in five that neither weights nor threshold saw.

    Pieces count as often as they stand in the sampled documents, those that stand on other
    hosts too included; `new_` measures are of the rest.  Seeds do not count.
    """
    sample = sample_lines(df, key, text, host)
    fold = sample.fold(5)
    seen = sample.part(fold != 0)
    fold[len(fold) - len(seed_pieces()) :] = 1
    report = {"pieces": float(len(sample.pieces)), "hosts": float(len({h for h, f in zip(sample.hosts, fold, strict=True) if f == 0}))}
    model = _trained(seen) if seen.both_labels() else NOTHING
    for name, rows in (("", (fold == 0) | (fold == -1)), ("new_", fold == 0)):
        held = sample.part(rows)
        found = held.scored(model) >= model.threshold
        both = held.counts[found & held.labels].sum()
        report[f"{name}precision"] = float(both / max(1.0, held.counts[found].sum()))
        report[f"{name}recall"] = float(both / max(1.0, held.counts[held.labels].sum()))
    return report | {"threshold": model.threshold}


def find_residue(df: DataFrame, key: str, text: str, model: LineModel) -> DataFrame:
    """(key, kind, line, score) of every line the model takes for residue, by the best of its pieces.

    `kind` is that of the phrases in the line, `page` where it has none of them: it names what
    was found and decides nothing.  `score` is a probability.  Null, empty and blank texts
    have no residue.  Whole texts are read; nothing is shuffled.
    """
    rows = spread(df.select(key, text))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                lines: list[str] = []
                owner: list[int] = []
                flags: list[tuple] = []
                parts: list[str] = []
                counts: list[int] = []
                size = 0
                while at < len(texts) and size < PIECE_BYTES:
                    own = content_lines(texts[at] or "")
                    lines += own
                    owner += [at] * len(own)
                    flags += _flags(own)
                    for line in own:
                        cut = segments(line)
                        parts += cut
                        counts.append(len(cut))
                        size += len(line)
                    at += 1
                if not lines:
                    continue
                buffer, starts, ends = _encoded(parts)
                each = np.array(counts)
                marks = np.repeat(np.array(flags, dtype=np.float32), each, axis=0)
                scored = model.scores(buffer, starts, ends, _features(ends - starts - 2, marks))
                scored[[i for i in np.flatnonzero(ends - starts - 2 < LEAST_BYTES) if len(_MARKED(parts[i])) == 1]] = -np.inf
                z = np.maximum.reduceat(scored, np.cumsum(each) - each)
                hit = np.flatnonzero(z >= model.threshold)
                found = [lines[i] for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([owner[i] for i in hit], pa.int64())),
                        pa.array([kind_of(x) or kind_within(x) or "page" for x in found], pa.string()),
                        pa.array(found, pa.string()),
                        pa.array(1 / (1 + np.exp(-np.clip(z[hit], -30, 30))), pa.float64()),
                    ],
                    names=[key, "kind", "line", "score"],
                )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(find, f"{key} {kind}, kind string, line string, score double")
