"""Which language a short text is in, by script and function words."""

from __future__ import annotations

import re

# --- fixed values: function words of languages in Latin and Cyrillic script ---------------
FUNCTION_WORDS: dict[str, str] = {
    "en": "the a an of to in is it its that this these those and or but not for with as on at by from be been "
    "are was were i we you my our your me he she they them his her their there here if then so than when "
    "where which who what how why will would should could can may must do does did has have had no yes "
    "before after only one now next let into while both see still because right too more over",
    "de": "der die das den dem des ein eine einen einem einer und oder aber nicht kein keine ist sind war waren "
    "ich wir sie er es man mir mich dir uns ihr ihm ihn von vom zu zum zur mit auf in im am an aus bei für "
    "durch über unter nach vor bis dass daß weil wenn als wie auch noch nur schon so da dort hier wird "
    "werden wurde hat haben kann können muss müssen soll sollte mehr wieder jetzt dann danach sonst dabei leider",
    "fr": "le la les l un une des du de d et ou mais ne pas non est sont était je j nous vous il elle ils elles on "
    "me se ce cet cette ces mon ma mes ton son sa ses notre votre leur à au aux en dans par pour sur avec sans "
    "que qu qui quoi dont où si comme plus moins encore déjà alors donc car puis ensuite avant après toute tout "
    "fait faut peut veux être avoir ai as a y c n s désolé",
    "es": "el la los las un una unos unas de del al y o pero no es son era está están yo nosotros usted él ella "
    "ellos me se te le lo les mi mis tu su sus nuestro a en con sin por para que qué quien como cómo cuando "
    "donde si más menos ya aún también muy hay ser estar ha he han puede puedo debe porque antes después ahora "
    "sobre entre hasta desde este esta esto ese esa eso nada ver quiero necesito",
    "pt": "o a os as um uma uns umas de do da dos das ao aos à às e ou mas não é são era está estão eu nós você ele "
    "ela eles me se te lhe meu minha seu sua nosso em no na nos nas num numa com sem por pelo pela para que "
    "quem como quando onde se mais menos já ainda também muito há ser estar foi tem têm pode posso deve porque "
    "pois antes depois agora sobre entre até desde este esta isto esse essa isso quero preciso",
    "it": "il lo la i gli le un uno una di del dello della dei degli delle a al alla e o ma non è sono era io noi "
    "voi lui lei loro mi si ti ci ne in nel nella con senza per da dal dalla che chi come quando dove se più "
    "meno già ancora anche molto c essere avere ho ha hanno può posso deve perché prima dopo adesso su questo "
    "questa quello quella",
    "nl": "de het een en of maar niet geen is zijn was waren ik wij we jij je u hij zij ze mij me van te in op aan "
    "met voor door over onder na naar uit bij dat die dit deze wie wat hoe wanneer waar als dan ook nog maar "
    "alleen al er wordt worden werd heeft hebben kan kunnen moet moeten zal zou meer weer nu eerst",
    "pl": "i w na z do nie jest są był była ja my ty on ona oni się to ten ta te tego tej że który która które co "
    "kto jak kiedy gdzie jeśli czy ale lub oraz za od po przed przez dla o u już jeszcze tylko też bardzo "
    "może mogę trzeba musi jako",
    "ru": "и в во не на я с со что а по это он она они мы вы как из у к ко за то от так его её их но да же бы для о "
    "об мне меня если уже или ни был была было были есть ещё еще до после перед когда где кто чтобы потому "
    "поэтому при надо нужно хочу могу может только теперь сейчас затем сначала этот эта эти тот та те там",
    "uk": "і й в у не на я з із що а по це він вона вони ми ви як до за то від так його її їх але та же б для про "
    "мені мене якщо вже або ні був була було були є ще після перед коли де хто щоб тому при треба можу може тільки",
}
_SCRIPTS = (
    ("zh", re.compile(r"[㐀-鿿豈-﫿]")),
    ("ja", re.compile(r"[぀-ヿ]")),
    ("ko", re.compile(r"[가-힣ᄀ-ᇿ]")),
    ("ar", re.compile(r"[؀-ۿ]")),
    ("he", re.compile(r"[֐-׿]")),
    ("el", re.compile(r"[Ͱ-Ͽ]")),
    ("hi", re.compile(r"[ऀ-ॿ]")),
    ("th", re.compile(r"[฀-๿]")),
)
_WEIGHTS: dict[str, dict[str, float]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _word in set(_words.split()):
        _WEIGHTS.setdefault(_word, {})[_language] = 0.0
for _word, _of in _WEIGHTS.items():
    for _language in _of:
        _of[_language] = 1.0 / len(_of)

_FENCES = re.compile(r"```.*?(?:```|\Z)", re.S)
_INLINE = re.compile(r"`[^`\n]*`|<[^<>\n]{1,80}>")
_CODE = re.compile(r"[/\\_=<>{}()\[\]\d]|\w\.\w|::|\b[A-Za-z]*[a-z][A-Z]").search


class _IsCode(dict):
    """Word -> whether it looks like code; words of text repeat, so short ones are remembered up to a bound."""

    def __missing__(self, word: str) -> bool:
        found = _CODE(word) is not None
        if len(word) <= 40:
            if len(self) >= 200_000:
                self.clear()
            self[word] = found
        return found


_is_code = _IsCode()
_LABEL = re.compile(r"^\s*(?:THOUGHT|REASONING|PLAN)\s*:", re.I | re.M)
_WORD = re.compile(r"[^\W\d_]+")
_CYRILLIC = re.compile(r"[Ѐ-ӿ]")


def prose_of(text: str) -> str:
    """A text without code blocks, inline code, tags, paths, identifiers and the thought label."""
    plain = _LABEL.sub(" ", _INLINE.sub(" ", _FENCES.sub(" ", text)))
    return "\n".join(" ".join([w for w in line.split() if not _is_code[w]]) for line in plain.split("\n"))


def language_of(prose: str) -> tuple[str | None, int]:
    """(language, its weight in letters) of prose; None where there is too little to tell."""
    words = _WORD.findall(prose.lower())
    letters = sum(map(len, words))
    if not letters:
        return None, 0
    for language, script in () if prose.isascii() else _SCRIPTS:
        n = len(script.findall(prose))
        if n * 3 >= letters:
            if language == "zh" and _SCRIPTS[1][1].search(prose):
                language = "ja"
            return language, letters * (3 if language in ("zh", "ja", "ko") else 1)
    cyrillic = not prose.isascii() and len(_CYRILLIC.findall(prose)) * 2 > letters
    score: dict[str, float] = {}
    for word in words:
        if word in _WEIGHTS:
            for language, weight in _WEIGHTS[word].items():
                if (language in ("ru", "uk")) == cyrillic:
                    score[language] = score.get(language, 0.0) + weight
    if not score:
        return ("ru", letters) if cyrillic else (None, letters)
    best = max(score, key=lambda k: (score[k], k))
    return best, letters
