"""Problem 3: defective answers of prompt and response pairs."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.llm.languages import language_of, prose_of
from quillspan.session import spread

DEFECTS = ("empty", "copy", "refusal", "truncated", "language")
COPY_SHARE = 0.7

# --- fixed values: how an assistant declines, by language ----------------------------------
_DO = (
    r"(?:help|assist|do (?:this|that|it)|comply|work on|carry|fulfil|proceed with|continue with (?:this|the)|take part|"
    r"support (?:this|that)|provide|participate|complete (?:this|that|the) (?:task|request|ticket)|"
    r"(?:edit|change|modify|touch|run|fix|handle|process|perform) (?:this|that|it|your|any|commands|the (?:request|task|ticket)))"
)
REFUSALS: dict[str, tuple[str, ...]] = {
    "en": (
        rf"\b(?:can(?:no|['’])t|can not|cannot|unable to|not able to|won['’]t(?: be able to)?|will not(?: be able to)?|"
        rf"am not going to|['’]m not going to|not willing to|could not possibly) {_DO}\b",
        r"\b(?:must|have to|need to|going to|will|would like to|['’]ll)(?: respectfully| politely)? (?:decline|refuse)\b",
        r"\bI (?:respectfully |politely )?(?:decline|refuse)\b",
        r"\b(?:have|need) to pass on (?:this|that)\b",
        r"\b(?:I['’]d|I would|would) rather not\b",
        r"\bnot (?:something|anything|a task) (?:that )?I(?:['’]m| am)? ?(?:can|able|could|may|willing|allowed)\b",
        r"\b(?:outside|beyond)(?: of)? (?:the scope of )?what I (?:can|am|may|could|['’]m)\b",
        r"\b(?:guidelines|policy|policies|rules|instructions|principles)\b[^.]{0,40}\b(?:not|n['’]t) (?:permit|allow|let)\b",
        r"\bnot (?:permitted|allowed|authorized|authorised) to\b[^.]*\b(?:help|assist|edit|change|touch|work|do)\b",
        r"\bwould(?: not|n['’]t) be (?:appropriate|right|proper|ethical) (?:for me )?(?:to|of me)\b",
        r"\b(?:don['’]t|do not|not) feel comfortable\b",
        r"\b(?:goes|go|is|be) against (?:the rules|my|the guidelines|policy)\b",
        r"\b(?:sorry|apologies)[,;:.—-]* (?:but )?no[.,!]",
        r"\bask (?:a maintainer|someone else|another person|a human) (?:instead|to do)\b",
    ),
    "de": (
        r"\bkann ich (?:dir |ihnen |euch |hier |dabei |damit |ihnen dabei )*(?:leider )?nicht (?:weiter)?(?:helfen|unterstützen|bearbeiten|übernehmen|ausführen)",
        r"\b(?:ich kann|kann|möchte ich|darf ich)\b[^.]{0,60}\bnicht (?:weiter)?(?:helfen|unterstützen|bearbeiten|übernehmen|ausführen|erledigen|durchführen|erfüllen)",
        r"\b(?:muss|möchte)\b[^.]{0,40}\b(?:ablehnen|absagen|verweigern)\b",
        r"\b(?:lehne|verweigere) (?:ich|diese|die|das|es)\b",
        r"\b(?:bin|sehe mich) nicht (?:in der lage|befugt|berechtigt)\b",
    ),
    "fr": (
        r"\bne (?:peux|pourrai|puis|veux|suis) (?:malheureusement |hélas )?pas (?:vous |t['’])?(?:aider|traiter|effectuer|répondre|prendre|donner|faire ce|accéder|en mesure|autorisé|m['’]occuper|réaliser|accomplir)",
        r"\b(?:je|j['’]) ?(?:dois|préfère|vais)\b[^.]{0,30}\b(?:refuser|décliner|ne pas)\b",
        r"\bje (?:refuse|décline|regrette, (?:mais )?je ne)\b",
        r"\bdans l['’]impossibilité de\b",
    ),
    "es": (
        r"\bno (?:puedo|podré|me es posible|estoy autorizad\w|quiero) (?:ayudar|atender|realizar|hacer(?:lo)?|cumplir|tramitar|continuar con|encargar|colaborar|trabajar en|para|modificar|tocar)",
        r"\b(?:debo|tengo que|prefiero|voy a)\b[^.]{0,30}\b(?:rechazar|rehusar|declinar|no hacerlo|negarme)\b",
        r"\b(?:rechazo|declino|me niego)\b",
        r"\bpide ayuda a otra persona\b",
    ),
    "pt": (
        r"\bnão (?:posso|poderei|consigo|estou autorizad\w|me é possível|quero) (?:ajudar|atender|realizar|fazer|cumprir|continuar com|tratar|colaborar|trabalhar|para|modificar|mexer)",
        r"\b(?:devo|tenho de|tenho que|prefiro|vou)\b[^.]{0,30}\b(?:recusar|declinar|não fazer)\b",
        r"\b(?:recuso|declino|nego-me)\b",
        r"\bpe[çc]a ajuda a outra pessoa\b",
    ),
    "ru": (
        r"\bне (?:могу|смогу|буду|стану|имею права|вправе)\b[^.]{0,30}\b(?:помочь|помогать|выполнить|выполнять|делать|сделать|взяться|браться|заняться|обработать|участвовать|продолжить|помощь)",
        r"\b(?:вынужден\w*|должен|должна|приходится)\b[^.]{0,30}\b(?:отказать|отказаться|отклонить)\b",
        r"\bотказываюсь\b",
    ),
    "zh": (
        r"(?:无法|不能|没法|不可以|无权|不便|不方便)[^。，]{0,8}(?:协助|帮助|帮忙|帮你|帮您|处理这|完成这|执行这|满足|提供|参与|继续这|回应|答应)",
        r"(?:必须|只能|不得不|我)(?:拒绝|婉拒|谢绝)",
        r"(?:抱歉|对不起|遗憾)[^。]{0,6}(?:我)?(?:无法|不能|没法|帮不)",
    ),
    "it": (r"\bnon (?:posso|sono in grado di|mi è possibile) (?:aiutar\w*|assister\w*|eseguire|svolgere|fare)",),
    "nl": (r"\bkan (?:ik )?(?:je |u )?(?:hier |daar )?(?:helaas )?niet (?:mee |bij )?(?:helpen|uitvoeren|assisteren)",),
}
_REFUSAL = re.compile("|".join(p for patterns in REFUSALS.values() for p in patterns), re.I)

_ZERO_WIDTH = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
_THOUGHT = re.compile(r"^\s*(?:THOUGHT|REASONING|PLAN|ANSWER|ASSISTANT|RESPONSE|COMMAND)\s*:", re.I | re.M)
_FENCE_MARK = re.compile(r"```[\w+-]*")
_FENCED = re.compile(r"```[^\n`]*\n?.*?```", re.S)
_FENCE_BODY = re.compile(r"```[^\n`]*\n?(.*?)```", re.S)
_IDLE = re.compile(r"(?:(?:(?:echo|printf|true|false|exit|pwd|sleep)\b|:)[^\n;&|<>]*|#[^\n]*)?(?:\s*\n(?:(?:echo|true|exit)\b[^\n;&|<>]*)?)*")
_QUOTED = re.compile(r"[\"“][^\"”\n]*[\"”]")
_ENVELOPE = re.compile(r"</?(?:returncode|output|tool_response)>|(?<=<returncode>)\d+(?=</returncode>)")
_VOID = re.compile(r"\b(?:n/?a|none|null|nil|nan|undefined|empty|todo|tbd)\b", re.I)
_USEFUL = re.compile(r"[^\W_]")
# a word that none of the marks above can hold
_PLAINLY_USEFUL = re.compile(
    r"(?<![`\w+-])(?!(?:thought|reasoning|plan|answer|assistant|response|command|none|null|undefined|empty|todo|returncode|output)\b)[^\W\d_]{4,}\b(?!\s*:)",
    re.I,
)
_QUOTE_MARK = re.compile(r"^\s*(?:>+|[*#-]+)\s?", re.M)
_WORDS = re.compile(r"\w+")
_SENTENCES = re.compile(r"(?<=[.!?。！？])\s+|\n+|(?<=[。！？])").split
_ENDED = tuple(".!?。！？…؟।")
_CLOSING = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "「": "」", "『": "』", "（": "）", "【": "】"}
_PAIRED = re.compile(r"(?<![:;=8][-'o])(?<![:;=8])[()\[\]{}“”«»「」『』（）【】]")  # smileys are no brackets
_INLINE = re.compile(r"`[^`\n]*`")
_CLOSERS = "\"'”’»)]}*_`」』）"


def _visible(text: str) -> str:
    return text if text.isascii() else text.translate(_ZERO_WIDTH)


def _useful(turn: dict) -> bool:
    text = _visible(turn.get("content") or "")
    if _PLAINLY_USEFUL.search(text):
        return True
    text = _VOID.sub(" ", _FENCE_MARK.sub(" ", _THOUGHT.sub(" ", _ENVELOPE.sub(" ", text))))
    return _USEFUL.search(text) is not None


def is_empty(answer: list[dict]) -> bool:
    """No turn holds a letter or digit besides labels, fences, envelopes and words for nothing."""
    return not any(map(_useful, answer))


def _words(text: str) -> list[str]:
    return _WORDS.findall(_QUOTE_MARK.sub("", _THOUGHT.sub(" ", text)).lower())


@dataclass(frozen=True)
class Source:
    """A text that may have been copied: its words in order and counted, and how short a copy can be."""

    words: list[str]
    bag: Counter[str]
    least_chars: int

    @classmethod
    def of(cls, text: str) -> Source | None:
        words = _words(text)
        if not words:
            return None
        shortest = sorted(map(len, words))[: math.ceil(COPY_SHARE * len(words))]
        return cls(words, Counter(words), sum(shortest) + len(shortest) - 1)

    def copied_by(self, words: list[str]) -> bool:
        """The texts begin alike for `COPY_SHARE` of the longer, or have that share of words in common."""
        n, m = len(self.words), len(words)
        least = COPY_SHARE * max(m, n)
        if min(m, n) < least:
            return False
        prefix = next((i for i, (a, b) in enumerate(zip(self.words, words, strict=False)) if a != b), min(m, n))
        return prefix >= least or (self.bag & Counter(words)).total() >= least


def is_copy(said: list[str], sources: list[Source]) -> bool:
    """What the assistant says, commands aside, is one of the sources, give or take a wrapping.

    Looked at are the whole answer and each turn, whatever the other turns do, with and
    without commands.
    """
    if not said or not sources:
        return False
    least = min(s.least_chars for s in sources)
    texts = ["\n".join(said), *(said if len(said) > 1 else ())]
    texts = [x for x in texts if len(x) >= least]
    for text in (*texts, *(_FENCED.sub(" ", x) for x in texts if "```" in x)):
        if len(text) >= least:
            words = _words(text)
            if any(s.copied_by(words) for s in sources):
                return True
    return False


def is_refusal(said: list[str]) -> bool:
    """The last turn declines, in its own words rather than in a quotation, and runs nothing.

    A command that does nothing (echo, true, exit) does not make it work.
    """
    if not said:
        return False
    last = _visible(said[-1])
    if any(not _IDLE.fullmatch(body.strip()) for body in _FENCE_BODY.findall(last)):
        return False
    prose = _QUOTED.sub(" ", _FENCED.sub(" ", last))
    return "```" not in prose and _REFUSAL.search(prose) is not None


def opens_without_closing(prose: str) -> bool:
    """The last paragraph opens a bracket or a directed quote that nothing after it closes."""
    depth: list[str] = []
    for mark in _PAIRED.findall(_INLINE.sub(" ", prose.rsplit("\n\n", 1)[-1])):
        if mark in _CLOSING:
            depth.append(_CLOSING[mark])
        elif mark in depth:
            del depth[len(depth) - 1 - depth[::-1].index(mark) :]
    return bool(depth)


def is_truncated(said: list[str]) -> bool:
    """The last assistant turn leaves a fence, bracket or quote open or its prose without an end."""
    if not said:
        return False
    last = _visible(said[-1]).rstrip()
    if last.count("```") % 2:
        return True
    tail = last.rsplit("```", 1)[-1].strip() if "```" in last else last
    if not tail:
        return False
    bare = tail.rstrip(_CLOSERS + " ")
    if not bare.endswith(_ENDED) or opens_without_closing(tail):
        return True
    word = bare.split()[-1].rstrip(".")
    return "/" in word and bare.endswith(".") and "." not in word.rsplit("/", 1)[-1] and "_" in word.rsplit("/", 1)[-1]


def other_language(said: list[str], ticket: str) -> bool:
    """More than half of the assistant's prose, by letters, is not in the ticket's language."""
    own, _ = language_of(prose_of(ticket))
    if own is None:
        return False
    same = other = 0
    for text in said:
        for sentence in _SENTENCES(prose_of(_QUOTED.sub(" ", _FENCED.sub(" ", text)))):
            language, letters = language_of(sentence)
            if language is None:
                continue
            if language == own:
                same += letters
            else:
                other += letters
    return other > same


def sources_of(*texts: str) -> list[Source]:
    """What each different text, if it has words, is compared as."""
    return [s for s in map(Source.of, dict.fromkeys(texts)) if s]


def defects(ticket: str, last_message: str, answer: list[dict] | None, sources: list[Source] | None = None) -> list[str]:
    """Every defect of one answer, in the order of the rules; the first is the one it is known by.

    `sources` can be passed where several answers to one prompt are looked at.
    """
    answer = [t for t in answer or [] if t]
    if is_empty(answer):
        return ["empty"]
    said = [t.get("content") or "" for t in answer if (t.get("role") or "").strip().lower() == "assistant"]
    said = [t for t in said if _useful({"content": t})] or said
    out = []
    if is_copy(said, sources if sources is not None else sources_of(ticket, last_message)):
        out.append("copy")
    if is_refusal(said):
        out.append("refusal")
    if is_truncated(said):
        out.append("truncated")
    if other_language(said, ticket):
        out.append("language")
    return out


def defective_answers(
    df: DataFrame, keys: list[str], prompt: str = "prompt", sides: tuple[str, ...] = ("chosen", "rejected")
) -> DataFrame:
    """(keys, side, defect, place): each triggered defect of each side, place 1 the one it is known by.

    The ticket is the prompt's first user turn (its first turn if there is none).  A null or
    empty answer is `empty`.  With a null or empty prompt nothing counts as copied or as in
    another language.  Repeated rows give repeated rows.  Narrow: nothing is shuffled; of the
    prompt only two turns reach Python.
    """
    turns = F.col(prompt)
    asked = F.filter(turns, lambda t: F.lower(F.trim(t["role"])) == "user")
    ticket = F.coalesce(F.get(asked, F.lit(0))["content"], F.get(turns, F.lit(0))["content"], F.lit(""))
    final = F.coalesce(F.try_element_at(turns, F.lit(-1))["content"], F.lit(""))
    rows = spread(df.select(*keys, ticket.alias("__ticket"), final.alias("__final"), *sides))
    out = T.StructType(
        [rows.schema[k] for k in keys]
        + [
            T.StructField("side", T.StringType()),
            T.StructField("defect", T.StringType()),
            T.StructField("place", T.IntegerType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    n_keys = len(keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tickets, finals, *answers = (c.to_pylist() for c in batch.columns[n_keys:])
            rows, sides_out, kinds, places = [], [], [], []
            for i, (asked, last) in enumerate(zip(tickets, finals, strict=True)):
                sources = sources_of(asked, last)
                for side, column in zip(sides, answers, strict=True):
                    for place, kind in enumerate(defects(asked, last, column[i], sources), start=1):
                        rows.append(i)
                        sides_out.append(side)
                        kinds.append(kind)
                        places.append(place)
            taken = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:n_keys]]
            found = [pa.array(sides_out, pa.string()), pa.array(kinds, pa.string()), pa.array(places, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip([*taken, *found], schema, strict=True)], schema=schema
            )

    return rows.mapInArrow(find, out)
