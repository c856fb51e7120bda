"""The operators on small tables against plain Python."""

import dataclasses
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan.llm import encoding, groups, overlap, packing, pairs, queries, quota, residue, runs
from quillspan.llm.commands import form_digest
from tests.llm.test_texts import TICKET, WORK, needs_vocabulary

TURNS = "array<struct<role:string,content:string>>"
WORDS = [f"w{i}" for i in range(60)]


# --- 1 ------------------------------------------------------------------------------------


def _overlap_by_hand(rows):
    def bag(messages):
        return Counter(w for r, c in messages or [] if r != "system" for w in (c or "").lower().split())

    found = set()
    for a, s, m in rows:
        for b, t, n in rows:
            if a is None or b is None or s != "train" or t not in ("validation", "test") or a == b:
                continue
            x, y = bag(m), bag(n)
            both, p, q = sum((x & y).values()), sum(x.values()), sum(y.values())
            if p and q and 5 * both >= 4 * p and 5 * both >= 4 * q:
                found.add((a, b))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_against_all_pairs(spark, seed, monkeypatch):
    rng = random.Random(seed)
    base = [[rng.choice(WORDS) for _ in range(rng.choice([1, 4, 9, 25, 60]))] for _ in range(25)]
    rows = [(None, "train", [("user", "w1")]), ("empty", "test", []), ("null", "train", None), ("sys", "test", [("system", "w1 w2")])]
    for i in range(220):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(words) // 3)):
            words[rng.randrange(len(words))] = rng.choice(WORDS).upper()
        if rng.random() < 0.3:
            rng.shuffle(words)
        cut = rng.randrange(len(words) + 1)
        rows.append((f"k{i}", rng.choice(["train", "test", "validation", None]), [("system", "x"), ("user", " ".join(words[:cut])), ("assistant", "\n".join(words[cut:]))]))
    rows += rows[-10:]
    df = spark.createDataFrame(rows, f"k string, split string, messages {TURNS}").withColumn("tokens", F.lit("clash"))
    if seed == 2:  # cells shared by many words
        monkeypatch.setattr(overlap.token_order, "__defaults__", (4,))
    got = overlap.split_overlaps(df, "k", overlap.spoken_words(F.col("messages")), F.col("split") == "train", F.col("split").isin("validation", "test"))
    assert {tuple(r) for r in got.collect()} == _overlap_by_hand(rows)
    none = overlap.split_overlaps(df.limit(0), "k", overlap.spoken_words(F.col("messages")), F.col("split") == "train", F.col("split") == "test")
    assert none.count() == 0


def test_overlap_report_has_one_row_per_source(spark, tmp_path):
    said = [("user", "one two three four five")]
    sources = ["mini-coder", "mini-coder ", "Mini-Coder", "mini_coder", "MINI CODER", "mini-coder-rs", None, "New_Pool", "newpool"]
    rows = [("t", "train", "mini-coder", said)] + [(f"e{i}", "test", x, said) for i, x in enumerate(sources)]
    rows.append(("e0", "test", "mini coder", said))
    spark.createDataFrame(rows, f"sample_id string, split string, source string, messages {TURNS}").write.parquet(str(tmp_path / "prefixes.parquet"))
    got = {(r.split, r.source): (r.n_pairs, r.n_eval, r.n_train) for r in queries.QUERIES["p1_report"](spark, str(tmp_path)).collect()}
    assert got == {("test", "mini-coder"): (5, 5, 1), ("test", "mini-coder-rs"): (1, 1, 1), ("test", None): (1, 1, 1), ("test", "newpool"): (2, 2, 1)}
    labels = spark.createDataFrame([("甲",), ("乙",), ("--",), (None,)], "s string").select(quota.spelled(F.col("s"), ("x",)))
    assert [r[0] for r in labels.collect()] == ["甲", "乙", "--", None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40), min_size=1)), min_size=1, max_size=6))
def test_banded_programming_counts_common_tokens(cases):
    a = [np.array(sorted(x), dtype=np.int64) for x, _ in cases]
    b = [np.array(sorted(y), dtype=np.int64) for _, y in cases]
    for got, (x, y) in zip(overlap.common_tokens(a, b), cases, strict=True):
        common, enough = len(x & y), overlap.needed(max(len(x), len(y)))
        assert (got == common) if common >= enough else (got < enough)


# --- 2 ------------------------------------------------------------------------------------

SPELLINGS = ["own__proj", "Own/Proj", " own__proj ", "https://forge.example/own/proj.git", "http://www.x.example/own/proj/tree/main", "git@x.example:own/proj.git", "own/proj/", "OWN__proj.git"]


def test_repo_keys(spark):
    others = ["own__proj-docs", "own__proj2", "other__proj", "https://forge.example/own/proj-docs"]
    df = spark.createDataFrame([(s,) for s in [*SPELLINGS, *others, "", " ", "noowner", None]], "r string")
    got = {r.r: r.k for r in df.withColumn("k", groups.repo_key(F.col("r"))).collect()}
    assert {got[s] for s in SPELLINGS} == {"own/proj"}
    assert [got[s] for s in others] == ["own/proj-docs", "own/proj2", "other/proj", "own/proj-docs"]
    assert got[""] is got[" "] is got["noowner"] is got[None] is None


def _components_by_hand(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    out = defaultdict(set)
    for x in list(parent):
        out[find(x)].add(x)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("edges_per_task", [3, 1000])
def test_components(spark, edges_per_task):
    rng = random.Random(3)
    links = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("hub", f"s{i}") for i in range(60)] + [("a", "a")]
    links += [(f"r{rng.randrange(80)}", f"r{rng.randrange(80)}") for _ in range(50)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a string, b string").repartition(7)
    out = defaultdict(set)
    for r in groups.components(df, edges_per_task).collect():
        out[r.root].add(r.node)
    assert sorted(map(sorted, out.values())) == _components_by_hand(links)
    assert groups.components(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), min_size=1, max_size=8))
def test_bulk_balance_is_the_greedy_one(sizes):
    shares = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
    total = sum(s * n for s, n in sizes.items())
    deficit = {k: total * v for k, v in shares}
    for size in sorted(sizes, reverse=True):
        for _ in range(sizes[size]):
            deficit[max(deficit, key=lambda k: deficit[k])] -= size
    plan = groups.balance(list(sizes.items()), shares)
    got = {k: total * v for k, v in shares}
    for size, parts in plan.items():
        assert sum(n for _, n in parts) == sizes[size]
        for k, n in parts:
            got[k] -= size * n
    assert sorted(got.values()) == pytest.approx(sorted(deficit.values()), abs=max(sizes))


def test_splits_keep_linked_rows_together(spark):
    rng = random.Random(5)
    rows = [(f"k{i}", f"o__p{rng.randrange(60)}" if rng.random() < 0.9 else None, f" I{rng.randrange(150)} " if rng.random() < 0.9 else None, 1) for i in range(400)]
    rows += [(f"h{i}", "hot__repo", None, 1) for i in range(200)] + [("k0", "o__p1", None, 1), (None, "o__p2", None, 1)]
    df = spark.createDataFrame(rows, "k string, repo string, inst string, root int")
    keys = {"repo": groups.repo_key(F.col("repo")), "instance": groups.instance_key(F.col("inst"))}
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split string, share double")
    split = {r.k: r.split for r in groups.grouped_split(df, "k", keys, targets).collect()}
    assert set(split) == {r[0] for r in rows if r[0]}
    for at in (1, 2):
        seen = defaultdict(set)
        for r in rows:
            if r[0] and r[at]:
                seen[r[at].strip().lower()].add(split[r[0]])
        assert all(len(v) == 1 for v in seen.values())
    assert groups.grouped_split(df.limit(0), "k", keys, targets).count() == 0
    shared = groups.must_share(df, "repo", keys)
    assert shared.count() == len({r[1] for r in rows if r[1]})


def test_rows_without_a_key_tie_splits(spark):
    rows = [(f"k{i}", f"o__p{i}", f"i{i}") for i in range(40)]
    rows += [(None, f"o__p{i}", f"i{i + 20}") for i in range(20)]
    df = spark.createDataFrame(rows, "k string, repo string, inst string")
    keys = {"repo": groups.repo_key(F.col("repo")), "instance": groups.instance_key(F.col("inst"))}
    targets = spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split string, share double")
    split = {r.k: r.split for r in groups.grouped_split(df, "k", keys, targets).collect()}
    assert set(split) == {f"k{i}" for i in range(40)}
    assert all(split[f"k{i}"] == split[f"k{i + 20}"] for i in range(20)) and len(set(split.values())) == 2
    roots = dict(groups.must_share(df, "repo", keys).select("repo", "root").collect())
    assert all(roots[f"o__p{i}"] == roots[f"o__p{i + 20}"] for i in range(20))


def test_any_number_of_splits_is_used(spark):
    members = spark.createDataFrame([(f"g{i}", i) for i in range(1200)], "root string, i int")
    targets = spark.createDataFrame([(f"s{i:04d}", 1 / 1200) for i in range(1200)], "split string, share double")
    assert groups.assign_groups(members, "root", targets).select("split").distinct().count() == 1200
    with pytest.raises(ValueError):
        groups.assign_groups(members, "root", targets.limit(0))


# --- 3 ------------------------------------------------------------------------------------


def test_defective_answers(spark):
    good = [("assistant", WORK)]
    rows = [("a", [("user", TICKET)], good, [("assistant", "")], 1), ("b", None, None, good, 2), ("c", [], good, good, 3), ("a", [("user", TICKET)], good, [("assistant", "")], 1)]
    df = spark.createDataFrame(rows, f"k string, prompt {TURNS}, chosen {TURNS}, rejected {TURNS}, side int")
    got = Counter((r.k, r.side, r.defect, r.place) for r in pairs.defective_answers(df, ["k"]).collect())
    assert got == {("a", "rejected", "empty", 1): 2, ("b", "chosen", "empty", 1): 1}
    assert pairs.defective_answers(df.limit(0), ["k"]).count() == 0


# --- 4 ------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_runs_across_partitions(spark, parts, monkeypatch):
    rng = random.Random(parts)
    events = []
    for seq, n in (("a", 400), ("b", 7), ("c", 1)):
        kind = "x"
        for pos in range(n):
            kind = rng.choice([kind, kind, kind, "x", "y", None])
            events.append((seq, pos, kind, rng.choice([None, pos])))
    events += [("d", p, "z", 1) for p in range(300)]
    want = []
    for seq in "abcd":
        own = [e for e in events if e[0] == seq]
        i = 0
        while i < len(own):
            j = i
            while own[i][2] is not None and j + 1 < len(own) and own[j + 1][2] == own[i][2]:
                j += 1
            if own[i][2] is not None:
                ms = [e[3] for e in own[i : j + 1] if e[3] is not None]
                want.append((seq, own[i][2], i, j, j - i + 1, sum(ms) if ms else None))
            i = j + 1
    rng.shuffle(events)
    df = spark.createDataFrame(events + events[:50], "s string, pos int, form string, ms bigint").repartition(5)
    monkeypatch.setattr(df.__class__, "repartitionByRange", lambda self, *c, _f=df.__class__.repartitionByRange: _f(self, parts, *c))
    got = [tuple(r) for r in runs.collapse_runs(df, ["s"]).collect()]
    assert sorted(got) == sorted(want)
    monkeypatch.setattr(runs, "FAN_IN", 2)  # several levels of the merge
    assert sorted(tuple(r) for r in runs.collapse_runs(df, ["s"]).collect()) == sorted(want)
    assert runs.collapse_runs(df.limit(0), ["s"]).count() == 0


def test_command_events(spark):
    rows = [("a", 1, ["ls", " ", None, "ls ;"], [5, None, 7]), ("b", 1, None, None), ("c", 1, [], []), ("d", None, ["x"], None)]
    df = spark.createDataFrame(rows, "k string, r int, commands array<string>, cmd_ms array<bigint>")
    got = {(r.k, r.pos): (r.form, r.ms, r.command) for r in runs.command_events(df, ["k", "r"], text=True).collect()}
    assert set(got) == {("a", 0), ("a", 1), ("a", 2), ("a", 3), ("d", 0)}
    own = form_digest("ls")
    assert got["a", 0] == (own, 5, "ls") and got["a", 1][0] is None and got["a", 3] == (own, None, "ls ;")


# --- 5 ------------------------------------------------------------------------------------


def test_quota_sample(spark):
    targets = spark.createDataFrame([("cold", "a-b", 0.5, 2), ("pre_edit", "a-b", 0.3, 2), ("cold", "c", 0.2, 30), ("pre_edit", "c", 0.0, 3)], "p string, s string, share double, min_rows bigint")
    rows = [(f"k{i}", ["cold", "COLD ", "Cold"][i % 3], ["a-b", "A B", "a_b"][i % 3], i) for i in range(2000)]
    rows += [(f"p{i}", ["pre-edit", "PreEdit"][i % 2], "a-b", i) for i in range(50)]
    rows += [(f"c{i}", "cold", "C", i) for i in range(20)] + [("x", "warm", "c", 1), (None, "cold", "c", 1), ("y", None, "c", 1), ("k0", "cold", "a-b", 9)]
    df = spark.createDataFrame(rows, "k string, p string, s string, u int")
    out = quota.quota_sample(df, targets, "k", ["p", "s"])
    cells = {(r.p, r.s): (r.target, r.available, r.drawn, r.deficit) for r in out.cells.collect()}
    n = 2070
    assert cells["cold", "a-b"] == (n // 10, 2000, n // 10, 0)
    assert cells["pre_edit", "a-b"] == (125, 50, 50, 75)
    assert cells["cold", "c"] == (83, 20, 20, 63)
    assert cells["pre_edit", "c"] == (3, 0, 0, 3)
    sample = out.sample.collect()
    assert len(sample) == len({r.k for r in sample}) == sum(c[2] for c in cells.values())
    again = quota.quota_sample(df.repartition(9), targets, "k", ["p", "s"]).sample.collect()
    assert set(sample) == set(again)
    empty = quota.quota_sample(df.limit(0), targets, "k", ["p", "s"])
    assert empty.sample.count() == 0 and {r.available for r in empty.cells.collect()} == {0}


# --- 6 and 7 ------------------------------------------------------------------------------


@needs_vocabulary
def test_ids_and_counts_of_a_table(spark):
    df = spark.createDataFrame([(1, "hello  world", 0), (2, "", 0), (3, None, 0), (None, "x", 0)], "id bigint, text string, ids int")
    ids = {r.id: r.ids for r in encoding.token_ids(df, "id", "text").collect()}
    counts = {r.id: r.tokens for r in encoding.token_counts(df, "id", "text").collect()}
    assert ids[2] == ids[3] == [] and ids[1] and {k: len(v) for k, v in ids.items()} == counts
    assert encoding.token_ids(df.limit(0), "id", "text").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_packing(spark, parts):
    rng = random.Random(7)
    sizes = [(i, rng.choice([0, None, 3, 40, 99, 100, 101, 730])) for i in range(500)]
    df = spark.createDataFrame(sizes + sizes[:20], "id bigint, tokens bigint").withColumn("free", F.lit(1)).repartition(parts)
    specs = spark.createDataFrame([("small", 100), ("one", 1)], "spec string, capacity int")
    rows = packing.pack(df, specs.where("spec = 'small'"), "id", open_bins=8, group_rows=200).collect()
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(df.repartition(3), specs.where("spec = 'small'"), "id", open_bins=8, group_rows=200).collect()))
    inside = defaultdict(int)
    pieces = defaultdict(list)
    for r in rows:
        inside[r.container] += r.tokens
        pieces[r.id].append((r.start, r.tokens))
    assert all(inside[r.container] + r.free == 100 for r in rows)
    for i, n in sizes:
        got = sorted(pieces[i])
        assert sum(t for _, t in got) == (n or 0) and (len(got) == 1 or n > 100)
        assert [s for s, _ in got] == [100 * j for j in range(len(got))]
    assert sum(inside.values()) / (100 * len(inside)) > 0.93
    summary = packing.pack_summary(packing.pack(df, specs, "id")).collect()
    assert {r.spec for r in summary} == {"small", "one"} and all(r.unused == 0 for r in summary if r.spec == "one")
    assert packing.pack(df.limit(0), specs, "id").count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, specs.withColumn("capacity", F.lit(0)), "id")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60), st.integers(1, 5))
def test_best_fit_takes_the_fullest_bin_that_holds_the_item(sizes, open_bins):
    bins, closed = packing.BestFit(20, open_bins), []
    free = {}
    for i, size in enumerate(sizes):
        fitting = [f for f in free.values() if f >= size]
        out = list(bins.put(size, (i, size)))
        closed += out
        assert len(out) <= 2 and len(bins.items) <= open_bins
        if not fitting and len(free) == open_bins:
            assert out[0][1] == min(free.values())
        free = {n: 20 - sum(s for _, s in items) for n, items in bins.items.items()}
    closed += bins.close()
    assert sorted(i for _, _, items in closed for i, _ in items) == list(range(len(sizes)))
    assert all(f == 20 - sum(s for _, s in items) for _, f, items in closed)


def test_containers_close_by_space_only(spark):
    sizes = [(i, None if i % 3 == 0 else 0 if i % 3 == 1 else 1) for i in range(24_000)]
    df = spark.createDataFrame(sizes, "id bigint, tokens bigint")
    specs = spark.createDataFrame([("wide", 8192), ("narrow", 100)], "spec string, capacity int")
    rows = packing.pack(df, specs, "id").collect()
    assert len(rows) == 2 * len(sizes)
    assert {(r.container, r.free) for r in rows if r.spec == "wide"} == {("wide:0:0", 192)}
    assert len({r.container for r in rows if r.spec == "narrow" and r.tokens}) == 80
    assert all(r.free == 0 for r in rows if r.spec == "narrow" and r.tokens)


# --- 8 ------------------------------------------------------------------------------------


def _corpus():
    rng = random.Random(9)
    nouns = "rows column queue header ledger mixer socket".split()

    def fine():
        return "\n\n".join(f"The {rng.choice(nouns)} is copied twice before the {rng.choice(nouns)} is read, so {rng.randrange(99)} remain." for _ in range(4))

    rows = [(i, fine(), f"o__r{i % 9}") for i in range(300)]
    bad = ["404 Not Found", "Please enable JavaScript to continue.", "xxx xxx xxx xxx xxx xxx", "Summary: {{ summary }}", "Your session has expired. Sign in again."]
    bad = [[f"Error {400 + i}: internal server error.", f"Summary: {{{{ field{i} }}}}", *bad][i % 7] for i in range(40)]
    rows += [(1000 + i, (fine() + "\n\n" if i % 2 else "") + bad[i], f"o__r{i % 9}") for i in range(40)]
    return fine, rows


def test_residue_of_a_table(spark):
    fine, rows = _corpus()
    rows += [(2000, "```\n404 Not Found\n```\n\n" + fine(), None), (2001, None, None), (2002, "", "x"), (2003, " \n", "x")]
    df = spark.createDataFrame(rows, "id bigint, text string, host string").withColumn("line", F.lit("clash"))
    model = residue.train(df, "id", "text", "host")
    found = residue.find_residue(df, "id", "text", model).collect()
    assert {r.id for r in found} == {1000 + i for i in range(40)}
    report = residue.validate(df, "id", "text", "host")
    assert report["hosts"] and report["recall"] >= 0.9 and report["precision"] >= 0.9
    nothing = residue.train(df.limit(0), "id", "text", "host")
    assert residue.find_residue(df, "id", "text", nothing).count() == 0
    assert residue.find_residue(df.limit(0), "id", "text", model).count() == 0


def test_the_classifier_decides(spark):
    """Weights alone make the difference: phrases neither add lines nor keep any."""
    _, rows = _corpus()
    df = spark.createDataFrame(rows, "id bigint, text string, host string")
    model = residue.train(df, "id", "text", "host")
    strict = dataclasses.replace(model, threshold=1e6)
    assert residue.find_residue(df, "id", "text", strict).count() == 0
    unlisted = ["That page could not be found here.", "The server is not available just now. Please try again later."]
    assert [residue.kind_of(x) for x in unlisted] == [None, None]
    pages = spark.createDataFrame(list(enumerate(unlisted)), "id bigint, text string")
    assert {(r.id, r.kind) for r in residue.find_residue(pages, "id", "text", model).collect()} == {(0, "page"), (1, "page")}


def test_plain_error_pages(spark):
    _, rows = _corpus()
    model = residue.train(spark.createDataFrame(rows, "id bigint, text string, host string"), "id", "text", "host")
    pages = [
        "404 Not Found. The requested page could not be found on this server.",
        "503 Service Unavailable - please try again later",
        "Sorry, this page isn't available right now.",
        "We're sorry, but something went wrong.",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "id bigint, text string")
    assert residue.find_residue(df, "id", "text", model).select("id").distinct().count() == len(pages)


def test_the_sample_is_there_at_any_size(spark):
    """The hash bound of a share of 10,000 documents in a million million keeps keys apart."""
    for n in (10**10, 10**12, 10**15):
        hashes = residue.hash_bound(residue.TRAIN_DOCS / n) + (1 << 63)
        assert abs(hashes / (1 << 64) * n / residue.TRAIN_DOCS - 1) < 1e-3
    assert residue.hash_bound(1.0) == (1 << 63) - 1
    _, rows = _corpus()
    df = spark.createDataFrame(rows, "id bigint, text string, host string")
    small = residue.sample_lines(df, "id", "text", "host", positive=5, negative=20)
    seeds = len(residue.seed_pieces())
    assert (small.labels[:-seeds].sum(), (~small.labels).sum()) == (5, 20)
    whole = residue.sample_lines(df, "id", "text", "host")
    ratio = small.counts[~small.labels].sum() / whole.counts[~whole.labels].sum()
    assert 0.5 < ratio < 2


def test_residue_on_long_lines(spark):
    links = "".join(f"<li><a href='#'>Entry number {w}</a></li>" for w in WORDS)
    report = "The reader stops after the ninth row and the list is then copied once more. " * 8
    rows = [
        ("minified", f"<html><head><meta charset=utf8></head><body><ul>{links}</ul><h1>Page not found</h1></body></html>"),
        ("titled", f"<html><head><title>404 Not Found</title></head><body><ul>{links}</ul></body></html>"),
        ("notice", f"<html><body><ul>{links}</ul><noscript>Please enable JavaScript.</noscript></body></html>"),
        ("unbroken", "Your session has expired. " + "Sign in again to see what was here before. " * 12),
        ("within", report + "Your session has expired. Sign in again."),
        ("report", report),
    ]
    assert all(len(x) > 400 for _, x in rows)
    assert [residue.kind_within(x) for _, x in rows[:3]] == ["error", "error", "notice"]
    _, corpus = _corpus()
    pages = [(3000 + i, f"<ul><li><a href='#'>Entry number {w}</a></li></ul>", "o__p") for i, w in enumerate(WORDS)]
    model = residue.train(spark.createDataFrame(corpus + pages, "id bigint, text string, host string"), "id", "text", "host")
    df = spark.createDataFrame(rows, "k string, text string")
    got = {r.k for r in residue.find_residue(df, "k", "text", model).collect()}
    assert got == {"minified", "titled", "notice", "unbroken", "within"}
