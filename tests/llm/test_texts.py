"""Tokens, defects, commands and residue of single texts."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import bpe, pairs, residue
from quillspan.llm.commands import canonical
from quillspan.llm.languages import language_of, prose_of

VOCABULARY = bpe.DEFAULT_VOCABULARY
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


@pytest.fixture(scope="module")
def encoder():
    return bpe.ByteBPE(VOCABULARY)


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    path = os.path.join(os.path.dirname(VOCABULARY), "byte_bpe_50k.json")
    if not os.path.exists(path):
        pytest.skip("no reference tokenizer")
    found = tokenizers.Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


@needs_vocabulary
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab '\n\t\xa0　é你😀١½_<|>.\x1c\x85​", max_size=40), max_size=5))
def test_ids_are_those_of_the_public_tokenizer(encoder, public, texts):
    flat, offsets = encoder.encode_batch(texts)
    for i, t in enumerate(texts):
        want = public.encode(t, add_special_tokens=False).ids
        assert flat[offsets[i] : offsets[i + 1]].tolist() == want == encoder.encode(t)
    assert encoder.count_batch(texts).tolist() == np.diff(offsets).tolist()


@needs_vocabulary
def test_special_strings_nulls_and_long_texts(encoder, public):
    texts = [None, "", "a<|endoftext|>b", "x" * 30_000 + " " * 50 + "é" * 5000, "  two  spaces "]
    flat, offsets = encoder.encode_batch(texts)
    assert offsets[2] == 0
    for i, t in enumerate(texts):
        assert flat[offsets[i] : offsets[i + 1]].tolist() == public.encode(t or "", add_special_tokens=False).ids
    small = bpe.ByteBPE(VOCABULARY, cache_entries=2)
    for _ in range(3):
        assert small.encode_batch(texts)[0].tolist() == flat.tolist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 9)), max_size=20))
def test_pair_tree_root_is_the_leftmost_minimum(values, changes):
    values = [v << 32 | i for i, v in enumerate(values)]
    tree = bpe.PairTree(values)
    for at, v in changes:
        if at < len(values):
            values[at] = v << 32 | at
            tree.put(at, values[at])
        assert tree.root() == min(values)


SAME = [
    ["sed -n '1,5p' a/b.py", 'sed  -n "1,5p" ./a/b.py;', "sed \\\n  -n '1,5p' a/b.py", "sed\xa0-n '1,5p' a/b.py  # again"],
    ["pytest -x -q t.py -k 'a'", "pytest -qx t.py -k a", "pytest --exitfirst --quiet -k a t.py"],
    ["RUN_TAG=1737474723 pytest t.py", "RUN_TAG=1737801032 pytest t.py"],
    ["pytest t.py --basetemp=/tmp/pt-2ccd13", "pytest --basetemp=/tmp/pt-aaffbb t.py"],
    ["git log -n 5 f", "git log --max-count=5 f", "git log -5 f"],
    ["grep -rn 'x' src/", "grep --recursive -n x src", "grep -n -r x ./src/"],
    ["ls -la d/", "ls -al d", "ls -l -a ./d/"],
    ["cat > f.py <<'PY'\nx = 1\nPY", "cat  > ./f.py <<'PY'\nx = 1\nPY"],
]
OTHER = [
    ("sed -n '1,5p' a.py", "sed -n '1,50p' a.py"),
    ("cat a.py", "cat a_ext.py"),
    ("grep -n x f", "grep -in x f"),
    ("grep -rn x src", "grep -rn x tests"),
    ("git diff f", "git diff --stat f"),
    ("python -c 'f(1, 2)'", "python -c 'f(2, 2)'"),
    ("pytest t.py -k a", "pytest t.py -k a_2"),
    ("LEVEL=1 make", "LEVEL=2 make"),
    ("cat > f <<'E'\nx = 1\nE", "cat > f <<'E'\nx = 2\nE"),
    ("a && b", "a || b"),
    ("find . -name a", "find . -iname a"),
    ("echo '$x'", 'echo "$x"'),
]


def test_commands_that_do_the_same():
    forms = [{canonical(c) for c in group} for group in SAME]
    assert all(len(f) == 1 for f in forms), forms
    assert len(set.union(*forms)) == len(SAME)
    for a, b in OTHER:
        assert canonical(a) != canonical(b), (a, b)
    assert canonical(None) is None and canonical(" \xa0\n") is None and canonical("#") is not None
    assert canonical("'unclosed") and canonical("x" * 100_000)


TICKET = "The parser drops the last row when the list holds more than nine entries. It should keep the order of the rows."
WORK = "THOUGHT: Let me look at the parser first.\n\n```bash\ncat parser.py\n```"


def answer(*texts):
    return [{"role": "assistant", "content": t} for t in texts]


@pytest.mark.parametrize(
    ("given_answer", "want"),
    [
        (None, ["empty"]),
        ([], ["empty"]),
        (answer("", " ​", None), ["empty"]),
        (answer("THOUGHT:"), ["empty"]),
        (answer("```bash\n\n```"), ["empty"]),
        (answer(TICKET), ["copy"]),
        (answer("THOUGHT: " + TICKET.lower() + "\n\n```bash\necho ok\n```"), ["copy"]),
        (answer("> " + TICKET.replace("last ", "")), ["copy"]),
        (answer('THOUGHT: The ticket says "It should keep the order of the rows."\n\n```sh\nls\n```'), []),
        (answer(WORK, "I'm sorry, but I can't help with changing the parser."), ["refusal"]),
        (answer("My guidelines do not permit me to touch parser.py.\n\n```bash\necho stopped\n```"), ["refusal"]),
        (answer("THOUGHT: I cannot reproduce the failure yet, so let me try again.\n\n```bash\nls\n```"), []),
        (answer(WORK, "THOUGHT: I can't rely on the parser here, it caches the rows."), []),
        (answer(WORK, "THOUGHT: The guard belongs in the par"), ["truncated"]),
        (answer("THOUGHT: Check it.\n\n```bash\npython -c 'print("), ["truncated"]),
        (answer(WORK, "THOUGHT: The result is right now."), []),
        (answer("Ich sehe mir zuerst die Datei an, weil die Meldung von dort kommt.\n\n```bash\nls\n```"), ["language"]),
        (answer("К сожалению, я не могу помочь с этой задачей."), ["refusal", "language"]),
        (answer(WORK), []),
    ],
)
def test_defects(given_answer, want):
    assert pairs.defects(TICKET, "<output>\n3\n</output>", given_answer) == want


def test_copies_over_any_number_of_turns():
    words = TICKET.split()
    thirds = answer(" ".join(words[:8]) + ".", " ".join(words[8:16]) + ".", " ".join(words[16:]))
    assert pairs.defects(TICKET, "", thirds) == ["copy"]
    for at in range(3):
        turns = [WORK, "THOUGHT: Now the rows are read once more, and the list is kept as it is.", "THOUGHT: Done."]
        for command in ("", "\n\n```bash\n" + "grep -rn rows parser.py lists.py\n" * 9 + "```"):
            turns[at] = TICKET + command
            assert pairs.defects(TICKET, "", answer(*turns))[:1] == ["copy"]
    assert pairs.defects(TICKET, "", answer(WORK, WORK, "THOUGHT: It should keep the order of the rows.")) == []


def test_answers_in_the_tickets_language_are_fine():
    ticket = "Der Fehler tritt seit Version 3 auf, vorher lief derselbe Auftrag ohne Beanstandung."
    assert pairs.defects(ticket, "", answer("Ich sehe mir zuerst die Datei an.\n\n```\nls\n```")) == []
    assert pairs.defects(ticket, "", answer(WORK)) == ["language"]
    assert pairs.defects("", "", answer(WORK)) == []


def test_languages():
    cases = {
        "en": "This is the first of the two rows that we have to keep.",
        "fr": "Il faut un nouveau test à côté de celui que nous avons.",
        "es": "En este archivo parece que el valor se cuenta dos veces.",
        "pt": "Na nossa máquina isto acontece umas vezes por dia, sempre dentro de uma classe.",
        "ru": "Перед правкой хочу увидеть сбой своими глазами.",
        "zh": "修改之前，我想亲眼看到失败。",
        "de": "Ein neuer Testfall gehört neben die anderen und darf sich nicht ändern.",
    }
    for language, text in cases.items():
        assert language_of(prose_of(text))[0] == language
    assert language_of("") == (None, 0) and language_of("12 _ 3") == (None, 0)


@pytest.mark.parametrize(
    ("line", "kind"),
    [
        ("Title: {{ title }}", "placeholder"),
        ("Affected release: <your version>.", "placeholder"),
        ("***VERSION TO BE ADDED***", "placeholder"),
        ("[branch eintragen]", "placeholder"),
        ("Rendering `{{ user.name }}` gives an empty string.", None),
        ('The string "__PLACEHOLDER__" is replaced twice.', None),
        ("xxx xxx xxx xxx xxx", "filler"),
        ("TBD TBD TBD TBD TBD TBD", "filler"),
        ("asdf jkl; qwer asdf test sdfg", "filler"),
        ("Lorem ante dolor nunc semper varis ipsum sed mira", "filler"),
        ("to be written, to be written, to be written, to be written,", "filler"),
        ("Please look at the rows before you look at the columns.", None),
        ("404 Not Found", "error"),
        ('<div class="msg">Your session has expired. Sign in again to see this page.</div>', "error"),
        ("СТРАНИЦА НЕ НАЙДЕНА. ВЕРНИТЕСЬ НА ГЛАВНУЮ.", "error"),
        ("The proxy logged 502 Bad Gateway 12 times while drain_rows was busy.", None),
        ("09:14:58 WARN reader answered 503 Service Unavailable", None),
        ("Please enable J​avaScript to continue.", "notice"),
        ('The banner saying "Please enable JavaScript" stays visible.', None),
        ("(one or two sentences)", "form"),
        ("", None),
    ],
)
def test_kinds_of_lines(line, kind):
    assert residue.kind_of(line) == kind


def test_code_and_output_are_no_content():
    text = 'a\n```html\n<noscript>Please enable JavaScript</noscript>\n```\nb\n<output>\n404 Not Found\n</output>\nc'
    assert residue.content_lines(text) == ["a", "b", "c"]
    assert residue.content_lines("```\nopen fence\n\nafter") == ["after"]


def test_classifier_separates_and_holds_on_unseen_lines():
    rng = np.random.default_rng(0)
    nouns = "rows column queue header ledger mixer socket".split()
    good = [f"The {nouns[i % 7]} is copied twice before the {nouns[j % 7]} is read, so {k} remain." for i, j, k in rng.integers(0, 99, (300, 3))]
    bad = [f"Error {k}: this page could not be shown. Please {w} later." for k in range(400, 420) for w in ("reload", "come back", "try again")]
    lines = good[:200] + bad[:40]
    labels = np.array([False] * 200 + [True] * 40)
    model = residue.fit(lines, np.zeros((240, 5), dtype=np.float32), labels, np.ones(240))
    held = good[200:] + bad[40:]
    buffer, starts, ends = residue._encoded(held)
    z = model.scores(buffer, starts, ends, residue._features(ends - starts - 2, np.zeros((len(held), 5))))
    assert (z[:100] < 0).all() and (z[100:] > 0).all()


def test_the_penalty_takes_effect():
    lines = [f"The queue is read {k} times before row {k * 7} is copied." for k in range(40)] + [f"This page {k} is gone." for k in range(9)]
    labels = np.array([False] * 40 + [True] * 9)
    flags, weights = np.zeros((49, 5), dtype=np.float32), np.ones(49)
    free, held = (residue.fit(lines, flags, labels, weights, **r) for r in ({"ridge": 0.0}, {"ridge": 1e-3}))
    assert np.square(held.grams).sum() < np.square(free.grams).sum()
    assert np.abs(held.grams - free.grams).max() > 0.1


def test_damaged_fences_still_hold_code():
    assert residue.content_lines("a\n`\t\t``html\n<noscript>Please enable JavaScript</noscript>\n```\nb") == ["a", "b"]
    assert residue.content_lines("`x` / `y` `z` and more") == ["`` / `` `` and more"]


def test_thresholds():
    scores, labels = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([True, True, False, True, False])
    ones = np.ones(5)
    assert residue.threshold_of(scores, labels, ones) == -0.5
    assert residue.threshold_of(scores, labels, np.array([1.0, 1.0, 9.0, 1.0, 1.0])) == 1.5
    assert residue.threshold_of(scores, np.zeros(5, dtype=bool), ones) == 0.0


def test_marked_pieces_of_long_sentences():
    line = "Assigned to %version% while the reader copies every row of the list twice, and nothing else in the setup has changed since then."
    assert residue.segments(line)[:2] == ["Assigned to ", "%version%"]
    assert "".join(residue.segments(line)) == line
    quoted = line.replace("%version%", "`<%= title %>`")
    assert residue.segments(quoted)[1] == "`<%= title %>`" and residue.kind_of(quoted) is None
    assert residue.segments("Title: {{ title }}") == ["Title: {{ title }}"]


@pytest.mark.parametrize(
    ("tail", "want"),
    [
        ("The call foo(bar, [1, 2. It is (see below.", True),
        ("He wrote “the rows are gone.", True),
        ("Die Meldung «fertig. Danach nichts.", True),
        ("The call foo(bar, [1, 2]) is right (see below).", False),
        ("All done :(.", False),
        ("a) first, b) second.", False),
        ("`foo(` is what the log says.", False),
        ("An open ( above.\n\nThe next paragraph is whole.", False),
    ],
)
def test_open_brackets_and_quotes(tail, want):
    assert pairs.opens_without_closing(tail) == want
    assert ("truncated" in pairs.defects(TICKET, "", answer(WORK, "THOUGHT: " + tail))) == want


def test_copied_prefix_and_sources():
    source = pairs.Source.of("one two three four five six seven eight nine ten")
    assert source.copied_by("one two three four five six seven".split())
    assert not source.copied_by("one two three four five six".split())
    assert source.copied_by("ten nine eight seven six five four three".split())
    assert pairs.Source.of("--") is None and len(pairs.sources_of("a b", "a b", "")) == 1


@pytest.mark.parametrize(
    "said",
    [
        "I'm afraid I cannot assist with that request.",
        "I will have to decline this one.",
        "That is not something I am able to do.",
        "Es tut mir leid, dabei kann ich nicht helfen.",
        "Je ne peux malheureusement pas vous aider avec cela.",
        "Lo siento, no puedo ayudar con esto.",
        "Desculpe, não posso ajudar com isso.",
        "Извините, я не могу выполнить эту задачу.",
        "很抱歉，我无法协助处理这个请求。",
    ],
)
def test_refusals_in_other_words(said):
    assert pairs.is_refusal([said])
