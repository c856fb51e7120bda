import re

import pytest
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import detect, ids, plain, text, turns
from tests.transcript import COMMANDS, TURNS, turns as transcript

TEXTS = [
    None,
    "",
    " \t\n",
    "\xa0\x1c",
    "no fence",
    "```bash\n  ls -la \xa0\n```",
    "```\n```",
    "```python\nprint(1)\n```\nprose\n```sh\nls\n```",
    "``` \nmake\n``` and ```bash\nlater\n```",
    "```shell\nx\ny\n```",
]


def test_fences_agree_with_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select("t", text.first_command(F.col("t")), text.unusable_reason(F.col("t"))).collect()
    for t, command, why in got:
        assert command == plain.first_command(t), t
        assert why == plain.unusable_reason(t), t


def test_submit_is_word_bounded_and_case_sensitive(spark):
    cases = {
        "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT": True,
        "echo SUBMIT_TASK_0A1B2C3D": True,
        "echo SUBMIT_TASK_0A1B2C3": False,
        "echo submit_task_0A1B2C3D": False,
        "echo xFINALIZE_AND_SUBMIT_TASK_OUTPUT": False,
        "pytest && echo FINALIZE_AND_SUBMIT_TASK_OUTPUT": True,
    }
    rows = spark.createDataFrame(list(cases.items()), "c string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", text.is_submit(F.col("c")).alias("got")).collect())


def test_edit_detector(spark):
    python = re.compile(V.EDIT)
    cases = [
        "sed -i s/a/b/ x",
        "sed\xa0-i s/a/b/ x",
        "echo 1 > out.txt",
        "make 2>err",
        "make 2>>err",
        "echo x > /tmp/y",
        "run >/dev/null",
        "x->y",
        "python -c 'print(3 > 2)'",
        "a &> b",
        "cat > f <<'E'",
        "tcp port",
        "scp x y",
        "git apply p",
        "patch  -p1",
        "",
        None,
    ]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    for c, got in df.select("c", detect.is_edit(F.col("c"))).collect():
        assert got == bool(python.search(c or "")), c


@pytest.mark.parametrize(
    ("test", "yes", "no"),
    [
        (detect.is_verify, ["pytest -q", "Python3  -c 1", "rake test"], ["pytests", "pytest; echo SUBMIT_TASK_00000000"]),
        (detect.is_claim, ["go test ./...", "pytest; echo SUBMIT_TASK_00000000"], ["python -m unittest", ""]),
        (detect.is_wide_search, ["find ./src", " grep -Rn x .", "find / -name x"], ["ls; find .", "grep -n x f"]),
        (detect.is_infra, ["pip install -U pytest", "python -m pip install pytest", "which pytest"], ["pip install x\npytest"]),
    ],
)
def test_detectors(spark, test, yes, no):
    df = spark.createDataFrame([(c, True) for c in yes] + [(c, False) for c in [*no, None]], "c string, want boolean")
    for c, want, got in df.select("c", "want", test(F.col("c"))).collect():
        assert got == want, c


def test_ids(spark):
    rows = [
        ("a__b.1234.pr_7", "mini-coder", "pr"),
        ("a__b.1234.lm_x", "mini-coder", "lm"),
        ("a__b.1234.combine_x", "mini-coder", "combine"),
        ("a__b.1234.func", "mini-coder", "mechanical"),
        ("a__b-7", "mini-coder", "pr"),
        ("a__b.1.func", "swe-hero", "pr"),
    ]
    df = spark.createDataFrame(rows, "i string, s string, want string")
    for i, want, got in df.select("i", "want", ids.family_of(F.col("i"), F.col("s"))).collect():
        assert got == want, i
    import hashlib

    for i, pick in df.select("i", ids.cold_pick(F.col("i"))).distinct().collect():
        assert pick == 1 + int(hashlib.sha256(i.encode()).hexdigest(), 16) % 2


@pytest.mark.parametrize(("phase", "edit", "want"), [("pre_edit", 5, 3), ("pre_edit", 2, 1), ("pre_edit", 0, 1), ("at_edit", 5, 5), ("at_edit", 0, 1)])
def test_turn_index(spark, phase, edit, want):
    assert spark.range(1).select(ids.turn_index_for(phase, F.lit(edit))).first()[0] == want


def test_parse_shard():
    assert ids.parse_shard("3/4") == (3, 4)
    for bad in ("4/4", "x/2", "1", "-1/2"):
        with pytest.raises(ValueError):
            ids.parse_shard(bad)


def test_transcript_cuts(spark):
    df = spark.createDataFrame([(transcript(),)], f"m {TURNS}")
    m = F.col("m")
    row = df.select(turns.first_edit_index(m).alias("fe"), turns.assistant_count(m).alias("n")).first()
    assert (row.fe, row.n) == (4, 7)
    for idx, label, n in ((1, "cold", 1), (2, "cold", 2), (3, "pre_edit", 3), (4, "at_edit", 4), (6, "at_edit", 6)):
        cut = turns.cut_before(m, F.lit(idx))
        got = df.select(turns.phase_of(cut), turns.assistant_count(cut), F.size(cut)).first()
        assert tuple(got) == (label, n, 2 * idx + 1)
    assert df.select(turns.cut_before(m, F.lit(7))).first()[0] is None


def test_cut_drops_empty_turns_and_maps_roles(spark):
    m = [("System", "s"), ("tool", "t"), ("user", ""), ("Assistant", "a"), ("assistant", None), ("assistant", "b")]
    df = spark.createDataFrame([(m,)], f"m {TURNS}")
    cut = df.select(turns.cut_before(F.col("m"), F.lit(2))).first()[0]
    assert [(t.role, t.content) for t in cut] == [("system", "s"), ("user", "t"), ("assistant", "a")]


def test_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(None,), ([],)], f"m {TURNS}")
    m = F.col("m")
    for row in df.select(
        turns.first_edit_index(m), turns.assistant_count(m), turns.char_count(m), F.size(turns.commands_of(m)), F.size(turns.prefix_of(m, m))
    ).collect():
        assert tuple(row) == (0, 0, 0, 0, 0)
    assert all(r[0] is None for r in df.select(turns.cut_before(m, F.lit(0))).collect())


def test_runs_and_ratio(spark):
    rows = [(["a", "a", "b", "a", "a", "a"], 3, 1 - 2 / 6), ([], 0, None), ([""], 1, 0.0), (["x", "y"], 1, 0.0)]
    df = spark.createDataFrame(rows, "c array<string>, run int, ratio double")
    for r in df.withColumn("a", turns.longest_equal_run(F.col("c"))).withColumn("b", turns.duplicate_ratio(F.col("c"))).collect():
        assert r.a == r.run and r.b == (None if r.ratio is None else pytest.approx(r.ratio))


def test_commands_come_from_assistant_turns(spark):
    df = spark.createDataFrame([(transcript(),)], f"m {TURNS}")
    assert tuple(df.select(turns.commands_of(F.col("m"))).first()[0]) == COMMANDS
