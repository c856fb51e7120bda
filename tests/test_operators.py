import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.operators import cutting, expand, masks, meters, pairing, sampling
from quillspan.operators.judge import judge, ratio_text
from quillspan.operators.latest import latest
from quillspan.operators.ordinals import with_ordinal
from quillspan.plans.queries import QUERIES
from quillspan.schema import PREFIX, ROLLOUT, TRAJECTORY
from tests.transcript import TURNS, say, turns as transcript


def trajectories(spark, rows):
    schema = "source string, shard string, row_in_shard int, instance_id string, first_edit int, repo string, extra string"
    return spark.createDataFrame([(*r, "x") for r in rows], f"{schema}").withColumn(
        "messages", F.lit(None).cast(TURNS)
    )


def prefix(spark, phase="cold"):
    row = dict.fromkeys(PREFIX.fieldNames()) | {
        "sample_id": "s:0:2", "phase_wanted": phase, "horizon": 4, "messages": transcript()[:5]
    }
    return spark.createDataFrame([tuple(row[f] for f in PREFIX.fieldNames())], PREFIX)


def test_entries_leave_out_leaks_and_rows_without_id(spark):
    source, leaked = V.LEAKED_INSTANCES[0]
    rows = [(source, "a", 0, leaked, None, None), (source, "a", 1, "x__y.1.func", 0, ""), (source, "a", 2, "", 3, None), (source, "a", 3, None, 3, None), (None, "a", 4, "z-1", None, "own")]
    got = {r.instance_id: r for r in cutting.trajectory_entries(trajectories(spark, rows)).collect()}
    assert set(got) == {"x__y.1.func", "z-1"}
    one = got["x__y.1.func"]
    assert (one.repo, one.family, one.language, one.asst, one.first_edit, one.messages) == ("x__y", "mechanical", "python", 0, 0, [])
    assert got["z-1"].repo == "own"


def test_character_limit_is_inclusive_and_spares_cold(spark):
    def rows(n):
        return [("user", "x" * n), say("ls"), say("ls")]

    df = spark.createDataFrame([(V.MAX_PREFIX_CHARS, rows(V.MAX_PREFIX_CHARS)), (V.MAX_PREFIX_CHARS + 1, rows(V.MAX_PREFIX_CHARS + 1))], f"n int, messages {TURNS}")
    df = df.selectExpr("'s' source", "'h' shard", "n row", "string(n) instance_id", "'r' repo", "'l' language", "'f' family", "2 asst", "1 first_edit", "messages")
    base = df
    from quillspan.functions import turns

    ok = base.select("row", turns.can_cut(F.col("asst"), "at_edit", F.lit(0), turns.cut_before(F.col("messages"), F.lit(0))).alias("ok"))
    assert {r.row: r.ok for r in ok.collect()} == {V.MAX_PREFIX_CHARS: True, V.MAX_PREFIX_CHARS + 1: False}
    cold = base.select(turns.can_cut(F.col("asst"), "cold", F.lit(0), turns.cut_before(F.col("messages"), F.lit(0))).alias("ok"))
    assert all(r.ok for r in cold.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=1, max_size=6), st.integers(0, 500))
def test_apportion_sums(weights, count):
    got = sampling.apportion([(str(i), w) for i, w in enumerate(weights)], count)
    assert sum(got.values()) == count
    assert all(abs(n - count * weights[int(k)] / sum(weights)) < 1 for k, n in got.items())


def test_apportion_published_counts():
    assert list(sampling.apportion(V.OVERFIT_PHASE_SHARES, 340).values()) == [187, 85, 68]
    assert list(sampling.apportion(V.OVERFIT_SOURCE_SHARES, 340).values()) == [194, 126, 13, 7]


def _greedy_by_hand(pool, count, cap, phase_want, source_want):
    got, phases, sources, repos = [], dict.fromkeys(V.PHASES, 0), {}, {}
    for key, source, repo, can in pool:
        if len(got) >= count:
            break
        if sources.get(source, 0) >= source_want.get(source, count) or repos.get(repo, 0) >= cap:
            continue
        for phase in sorted(V.PHASES, key=lambda p: -(phase_want[p] - phases[p])):
            if can[phase] and phases[phase] < phase_want[phase]:
                got.append((key, phase))
                phases[phase] += 1
                sources[source] = sources.get(source, 0) + 1
                repos[repo] = repos.get(repo, 0) + 1
                break
    return got


def test_greedy_pick_equals_the_serial_fold_over_everything(spark, monkeypatch):
    rng = random.Random(1)
    n = 600
    rows = []
    for i in range(n):
        edit = rng.choice([0, 1, 3, 4, 6])
        repo = "hot" if rng.random() < 0.4 else f"r{rng.randrange(40)}"
        rows.append((rng.choice(V.SOURCES), "sh", i, repo, i * 7919 % 1000, rng.random() < 0.9, edit >= 4, edit >= 1))
    schema = "source string, shard string, row int, repo string, __h bigint, can_cold boolean, can_pre_edit boolean, can_at_edit boolean"
    df = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(sampling, "pick_candidates", lambda entries, seed: entries)
    for count, cap, limit in ((50, 3, 999), (200, 8, 999), (50, 3, 2), (200, 8, 5)):
        monkeypatch.setattr(sampling, "_GROUP_LIMIT", limit)  # as if counts and caps were large
        got = sorted(sampling.greedy_pick(df, count=count, repo_cap=cap).collect(), key=lambda r: r.pick_ord)
        pool = [(r[2], r[0], r[3], dict(zip(V.PHASES, r[5:], strict=True))) for r in sorted(rows, key=lambda r: (r[4], r[1], r[2]))]
        want = _greedy_by_hand(pool, count, cap, sampling.apportion(V.OVERFIT_PHASE_SHARES, count), sampling.apportion(V.OVERFIT_SOURCE_SHARES, count))
        assert [(r.row, r.phase) for r in got] == want
        assert [r.horizon for r in got] == [V.HORIZONS[i % 2] for i in range(len(got))]


def test_first_by_hash_against_sorting(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_GROUP_LIMIT", 0)
    rng = random.Random(3)
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(40)]
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice(hashes), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, h bigint, i int")
    for most in (1, 7, 60, 1000):
        got = {tuple(r) for r in sampling.first_by_hash(df, ["g"], most, "h", ["i"]).collect()}
        want = {r for g in ("a", "b", None) for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])[:most]}
        assert got == want
    assert sampling.first_by_hash(df.limit(0), ["g"], 2, "h", ["i"]).count() == 0


def test_pool_head_counts_repeated_rows(spark):
    schema = "source string, shard string, row int, instance_id string, body string"
    rows = [("x", "s", 1, "a", "1"), ("swe-hero", "s", 2, "a", "2"), ("swe-hero", "s", 2, "a", "2"), ("swe-hero", "s", 1, None, "3"), ("mini-coder", "s", 9, "a", "4"), (None, None, 0, "a", "5")]
    df = spark.createDataFrame(rows, schema)
    order = ["4", "3", "2", "2", "5", "1"]
    for n in range(8):
        assert sorted(r.body for r in cutting.pool_head(df, n).collect()) == sorted(order[:n])
    assert cutting.pool_head(df.limit(0), 3).count() == 0


def test_ordinals(spark):
    values = [5, 3, 3, 9, None, 1, 3]
    for parts in (1, 3):
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(parts)
        got = [r.i for r in sorted(with_ordinal(df, ["v", "i"]).collect(), key=lambda r: r.ordinal)]
        assert got == [4, 5, 1, 2, 6, 0, 3]
    within = {(r.v, r.i): r.ordinal for r in with_ordinal(df, ["v", "i"], within=["v"]).collect()}
    assert [within[3, i] for i in (1, 2, 6)] == [0, 1, 2] and within[9, 3] == 0
    assert with_ordinal(df.limit(0), ["v"]).count() == 0


def test_splits(spark):
    df = spark.createDataFrame([(f"k{i:03d}", "ab"[i % 2]) for i in range(100)], "k string, s string")
    held = sampling.head_split(df, ["k"], 40)
    assert [r.k for r in held.where("held_out").orderBy("k").collect()] == [f"k{i:03d}" for i in range(40)]
    more = df.union(spark.createDataFrame([(f"n{i}", None) for i in range(10)], df.schema))
    strata = sampling.stratified_split(more, ["s"], ["k"], 0.1).where("held_out").collect()
    assert {r.k for r in strata} == {f"k{i:03d}" for i in range(10)} | {"n0"}
    assert sampling.stratified_split(df.limit(0), ["s"], ["k"], 0.1).count() == 0
    assert sampling.head_split(df.limit(0), ["k"]).count() == 0
    assert sampling.modulo_shard(df, ["k"], 3, 4).count() == 25
    apart = sampling.disjoint_from(df, df.where("s = 'a'"), ["s"])
    assert apart.count() == 50


def test_latest(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", None, "only"), (None, 1, "null key")]
    df = spark.createDataFrame(rows, "k string, loaded_at int, v string")
    assert {(r.k, r.v) for r in latest(df, ["k"]).collect()} == {("a", "new"), ("b", "only"), (None, "null key")}


def test_scripted_and_python_rollouts_agree(spark):
    p = prefix(spark)
    a = expand.roll_scripted(p, 3).drop("backend").orderBy("rollout").collect()
    b = expand.roll_with(p, 3, lambda r: expand.verifying_policy if r % 2 else expand.skipping_policy).drop("backend").orderBy("rollout").collect()
    assert a == b
    assert [r.stopped for r in a] == ["submit", "horizon", "submit"]
    assert [len(r.commands) for r in a] == [3, 4, 3]
    never = p.withColumn("horizon", F.lit(-2))
    a, b = expand.roll_scripted(never, 2), expand.roll_with(never, 2, lambda _r: expand.skipping_policy)
    for row in [*a.collect(), *b.collect()]:
        assert row.commands == [] and row.continuation == [] and row.stopped == "horizon"


def test_bad_turns_end_a_rollout(spark):
    said = lambda _messages, step: ["```sh\nls\n```", "no command", "x"][step]
    row = expand.roll_with(prefix(spark), 1, lambda _r: said).first()
    assert row.stopped == "bad_turn:no bash block" and row.commands == ["ls"] and len(row.continuation) == 3
    blank = expand.roll_with(prefix(spark), 1, lambda _r: lambda _m, _s: " ").first()
    assert blank.stopped == "bad_turn:empty" and blank.commands == []


def rollout(spark, commands, phase="cold", before=(), stopped="horizon"):
    head = transcript(before)
    tail = transcript(commands)[1:]
    row = dict.fromkeys(ROLLOUT.fieldNames()) | {
        "sample_id": "s", "rollout": 1, "phase_wanted": phase, "stopped": stopped, "commands": list(commands), "messages": head + tail, "continuation": tail
    }
    return spark.createDataFrame([tuple(row[f] for f in ROLLOUT.fieldNames())], ROLLOUT)


EDIT, CHECK, SUBMIT = "sed -i s/a/b/ f.py", "pytest -q", "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"


@pytest.mark.parametrize(
    ("commands", "phase", "before", "want"),
    [
        ([CHECK, EDIT, CHECK, SUBMIT], "cold", (), []),
        ([EDIT, CHECK], "cold", (), ["edit_before_repro"]),
        ([EDIT, CHECK], "cold", (CHECK,), []),
        ([EDIT, "ls", SUBMIT], "pre_edit", (), ["no_verify_after_edit", "submit_without_verify"]),
        (["ls"], "cold", (), ["no_source_edit"]),
        (["ls"] * 4, "at_edit", (), ["loop:4x same command"]),
        (["ls", "a", "ls", "a"], "at_edit", (), ["loop:dup_ratio=0.50"]),
        (["find . -name x", "grep -rn a .", "find . -type f"], "pre_edit", (), ["no_source_edit", "restart_wide_search", "search_spam"]),
        (["pip install pytest", "which pytest"], "at_edit", (), ["infra_thrash"]),
        (["ls"], "at_edit", (EDIT,), ["no_verify_after_edit"]),
        (["ls", CHECK], "at_edit", (EDIT,), []),
        ([EDIT, CHECK, EDIT], "cold", (), ["no_verify_after_edit"]),
        ([EDIT, f"{CHECK}; {SUBMIT}"], "pre_edit", (), ["no_verify_after_edit", "submit_without_verify"]),
        (["ls", EDIT, CHECK], None, (), ["edit_before_repro"]),
    ],
)
def test_rules(spark, commands, phase, before, want):
    row = judge(rollout(spark, commands, phase, before)).first()
    assert row.reasons == want and row.keep == (not want) and row.drop == bool(want)


def test_rules_on_nulls(spark):
    df = spark.createDataFrame([tuple([None] * len(ROLLOUT))], ROLLOUT).withColumn("reasons", F.lit("clash"))
    assert judge(df).first().reasons == ["no_source_edit"]
    bad = rollout(spark, ["ls"], "at_edit", stopped="bad_turn:empty")
    assert judge(bad).first().reasons == ["bad_turn:empty"]
    assert judge(bad.limit(0)).count() == 0


def test_ratio_text_rounds_as_python(spark):
    rows = [([str(i % d) for i in range(n)], f"{1 - d / n:.2f}") for n in (8, 16, 24, 40, 200) for d in range(1, n + 1, 3)]
    rows += [([str(i % 3) for i in range(8)], "0.62")]
    df = spark.createDataFrame(rows, "c array<string>, want string")
    from quillspan.functions.turns import duplicate_ratio

    for r in df.withColumn("got", ratio_text(F.col("c"), duplicate_ratio(F.col("c")))).collect():
        assert r.got == r.want, len(r.c)


def judged_rows(spark, groups):
    rows = [(s, i, k == "k", k == "d", ["r"] if k == "d" else [], "cold", transcript()[:1] + transcript()[1:3], transcript()[1:3], ["ls"]) for s, kinds in groups.items() for i, k in enumerate(kinds, 1)]
    schema = f"sample_id string, rollout int, keep boolean, drop boolean, reasons array<string>, phase_wanted string, messages {TURNS}, continuation {TURNS}, commands array<string>"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_pairing(spark, parts):
    df = judged_rows(spark, {"a": "kkkd", "b": "kddd", "c": "kk", "d": "dd", "e": "dkdk"}).repartition(parts)
    got = {(r.sample_id, r.chosen_rollout, r.rejected_rollout) for r in pairing.dpo_rows(df).collect()}
    assert got == {("a", 1, 4), ("b", 1, 2), ("e", 2, 1), ("e", 4, 3)}
    assert tuple(pairing.unpaired_keeps(df).first()) == (8, 4, 4)
    assert pairing.sft_rows(df).count() == 8 and {r.n_prefix for r in pairing.sft_rows(df).collect()} == {1}
    states = {r.sample_id: r.state for r in pairing.ready_tickets(df).collect()}
    assert states == {"a": "both", "b": "both", "c": "all_keep", "d": "all_drop", "e": "both"}
    assert pairing.readiness(df, 8, 3).first().ready and not pairing.readiness(df, 9, 3).first().ready
    assert pairing.dpo_rows(df.limit(0)).count() == 0
    nameless = df.withColumn("sample_id", F.when(F.col("sample_id") != "e", F.col("sample_id")))
    assert {(r.sample_id, r.chosen_rollout, r.rejected_rollout) for r in pairing.dpo_rows(nameless).collect()} == got_of(got)


def got_of(got):
    return {(None if s == "e" else s, a, b) for s, a, b in got}


def test_meters(spark):
    p = prefix(spark)
    report = meters.meter_report(judge(expand.roll_scripted(p, 2)))
    assert report["n"] == {"cold": 2, "pre_edit": 0, "all": 2}
    assert report["cold_edit_rate"] == 1.0 and report["cold_verify_rate"] == 0.5 and report["loop_rate"] == 0.5
    assert report["pre_edit_no_wide"] is None
    json.dumps(report)


def test_counters(spark):
    df = spark.createDataFrame([("cold", "a", None, "cold"), ("cold", "b", "pr", None)], "phase_wanted string, source string, family string, phase_labeled string")
    got = {(r.what, r.value): r.n for r in meters.counters(df).collect()}
    assert got["phase_wanted", "cold"] == 2 and got["family", None] == 1
    assert tuple(meters.phase_mismatch(df).first()) == (2, 1)


def _mask_by_hand(messages, n_prefix):
    blocks = [(r, c) for i, (r, c) in enumerate(messages) if r in ("user", "assistant") or (r == "system" and i == 0)]
    before = sum(1 for i, (r, c) in enumerate(messages[:n_prefix]) if r in ("user", "assistant") or (r == "system" and i == 0))
    text, spans, cut = "", [], None
    for i, (r, c) in enumerate(blocks):
        if i == before:
            cut = len(text)
        start = len(text)
        text += f"<|im_start|>{r}\n{c}<|im_end|>\n"
        if r == "assistant" and i >= before:
            spans.append((start, len(text)))
    return text, spans, len(text) if cut is None else cut


def test_masks(spark):
    cases = [([("system", "s"), *transcript()], 3), (transcript(), 0), (transcript(), 99), ([("user", "a"), ("system", "late"), ("assistant", "b é")], 2)]
    df = spark.createDataFrame([(i, m, n) for i, (m, n) in enumerate(cases)], f"sample_id int, messages {TURNS}, n_prefix int")
    plan = masks.loss_plan(F.col("messages"), F.col("n_prefix"))
    for r in df.select("sample_id", masks.render(F.col("messages")).alias("t"), plan.alias("p")).collect():
        text, spans, cut = _mask_by_hand(*cases[r.sample_id])
        assert (r.t, [tuple(s) for s in r.p.spans], r.p.cut) == (text, spans, cut)
    kept = {r.sample_id: r for r in masks.sft_examples(df).collect()}
    assert set(kept) == {0, 1, 3}
    for k, r in kept.items():
        text, spans, cut = _mask_by_hand(*cases[k])
        ids, offsets = masks.blank_tokenizer(text)
        want = [t if s >= cut and any(a < e and s < b for a, b in spans) else -100 for t, (s, e) in zip(ids, offsets, strict=True)]
        assert r.labels == want and r.input_ids == ids and set(r.attention_mask) == {1}
    short = masks.sft_examples(df, max_len=3).where("sample_id = 0").first()
    assert set(short.labels) == {-100} and masks.sft_examples(df, max_len=3, drop_fully_masked=True).where("sample_id = 0").count() == 0
    assert tuple(masks.skip_counts(df, masks.sft_examples(df)).first()) == (4, 3, 1)


def test_long_rollouts_keep_what_is_learned(spark, tmp_path):
    def words(n):
        return " ".join(f"w{i}" for i in range(n))

    prompt, late = ("user", words(600)), ("assistant", words(700))
    rows = [("a", 1, [prompt, late], [late]), ("a", 2, [("user", "x"), late], [late]), ("b", 1, [("user", "x"), ("assistant", words(9000))], [("assistant", words(9000))])]
    df = spark.createDataFrame(rows, f"sample_id string, rollout int, messages {TURNS}, continuation {TURNS}").withColumn("loaded_at", F.lit(None).cast("timestamp"))
    df.write.parquet(str(tmp_path / "rollouts.parquet"))
    got = {(r.sample_id, r.rollout): (r.n, r.learned) for r in QUERIES["sft_tokens_long"](spark, str(tmp_path)).collect()}
    size = {k: sum(len(masks.blank_tokenizer(f"<|im_start|>{r}\n{c}<|im_end|>\n")[0]) for r, c in m) for *k, m, _ in rows for k in [tuple(k)]}
    learned = len(masks.blank_tokenizer(f"<|im_start|>assistant\n{late[1]}<|im_end|>\n")[0])
    assert got["a", 1] == (size["a", 1], learned) and got["a", 2] == (size["a", 2], learned)
    assert got["b", 1][0] == 8192 < size["b", 1]
    pads = {r.sample_id: (r.shortest, r.longest, r.pads) for r in QUERIES["pad_batch_long"](spark, str(tmp_path)).collect()}
    most = size["a", 1]
    assert pads == {"a": (most, most, most - size["a", 2]), "b": (8192, 8192, 0)}


def test_user_query_and_blocks(spark):
    rows = [([("user", " <tool_response>x</tool_response>\n")], False), ([("user", "<tool_response>x</tool_response> y")], True), ([("assistant", "a")], False), (None, False), ([("user", None)], True)]
    df = spark.createDataFrame(rows, f"m {TURNS}, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", masks.has_user_query(F.col("m"))).collect())


def test_padding(spark):
    rows = [("a", [1, 2, 3], [1, 1, 1], [-100, 2, 3]), ("a", [4], [1], [4]), ("b", [5], [1], [5])]
    df = spark.createDataFrame(rows, "b string, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = {tuple(r.input_ids): (r.attention_mask, r.labels) for r in masks.padded(df, "b", 0).collect()}
    assert got[4, 0, 0] == ([1, 0, 0], [4, -100, -100]) and got[5,] == ([1], [5])
    numbered = {tuple(r.input_ids): r.batch for r in masks.batched(df, ["input_ids"], 2).collect()}
    assert numbered == {(1, 2, 3): 0, (4,): 0, (5,): 1} and masks.batched(df.limit(0), ["b"], 2).count() == 0


def test_usable_dpo(spark):
    one = [("user", "x")]
    df = spark.createDataFrame([(one, one, one, 1), (one, [], one, 2), (one, None, one, 3)], f"prompt {TURNS}, chosen {TURNS}, rejected {TURNS}, extra int")
    assert pairing.usable_dpo(df).count() == 1 and pairing.usable_dpo(df).columns == ["prompt", "chosen", "rejected"]


def test_trajectory_schema_has_no_surprises():
    assert TRAJECTORY.fieldNames() == ["instance_id", "messages", "repo", "language", "family", "first_edit"]
