import json

import pytest
from pyspark.sql import functions as F

from quillspan import cli
from quillspan.operators.judge import judge
from quillspan.schema import JUDGED
from quillspan.sources import records
from tests.test_operators import CHECK, EDIT, rollout
from tests.transcript import TURNS, turns as transcript


def test_steps_from_trajectories_to_meters(spark, tmp_path, capsys):
    rows = [(f"own__proj{i}.1.func", transcript()) for i in range(6)]
    df = spark.createDataFrame(rows, f"instance_id string, messages {TURNS}")
    df.coalesce(1).write.parquet(str(tmp_path / "raw"))
    target = tmp_path / "pool" / "mini-coder" / "data"
    target.mkdir(parents=True)
    next((tmp_path / "raw").glob("*.parquet")).rename(target / "train-00000.parquet")

    def run(*argv):
        return cli.main([a if a.startswith("-") or a in cli_words else str(tmp_path / a) for a in argv], spark)

    cli_words = {"cut", "roll", "filter", "pack", "gate", "recipe", "examples", "4", "2", "16"}
    assert run("cut", "--data-root", "pool", "--out", "prefixes", "--count", "4") == 0
    assert run("cut", "--data-root", "nothing", "--out", "none") == 2
    assert run("roll", "--prefixes", "prefixes", "--out", "rollouts", "--n", "2") == 0
    assert run("filter", "--rollouts", "rollouts", "--out-dir", "judged") == 0
    assert run("pack", "--judged", "judged", "--out-dir", "packed") == 0
    assert run("gate", "--judged", "judged", "--out", "gate.json") == 0
    assert run("examples", "--sft", "packed/sft", "--out", "tokens", "--max-len", "16") == 0
    assert cli.main(["recipe", "--base", "b", "--sft", "s", "--dpo", "d", "--out-dir", str(tmp_path / "train")]) == 0
    report = json.loads((tmp_path / "gate.json").read_text())
    picked = len(list(spark.read.json(str(tmp_path / "prefixes")).collect()))
    assert report["n"]["all"] == 2 * picked > 0
    assert spark.read.json(str(tmp_path / "packed" / "sft")).count() >= 1
    assert "reason:" in capsys.readouterr().out


def test_pack_reads_all_forms_of_judged_rollouts(spark, tmp_path):
    rows = judge(rollout(spark, [CHECK, EDIT, CHECK]).union(rollout(spark, ["ls"]).withColumn("rollout", F.lit(2))))
    rows = rows.select(*JUDGED.fieldNames())
    for name, part in (("both", rows), ("keep", rows.where("keep")), ("drop", rows.where("drop"))):
        records.write_jsonl(part, str(tmp_path / name))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    assert cli.main(["pack", "--rollouts", str(tmp_path / "both"), "--out-dir", one], spark) == 0
    assert cli.main(["pack", "--keep", str(tmp_path / "keep"), "--drop", str(tmp_path / "drop"), "--out-dir", two], spark) == 0
    for kind in ("sft", "dpo"):
        got = [sorted(r.value for r in spark.read.text(f"{d}/{kind}").collect()) for d in (one, two)]
        assert got[0] == got[1] and len(got[0]) == 1
    assert cli.main(["pack", "--keep", "x", "--out-dir", "y"], spark) == 2


@pytest.mark.parametrize("step", ["cut", "roll", "filter", "pack"])
def test_self_tests(spark, step, capsys):
    assert cli.main([step, "--self-test"], spark) == 0
    assert capsys.readouterr().out.endswith("PASS\n")


def test_live_runs_are_refused(capsys):
    assert cli.main(["gate", "--out", "x", "--run"]) == 2
    assert cli.main(["recipe", "--base", "b", "--sft", "s", "--dpo", "d", "--out-dir", "o", "--run"]) == 2
    assert capsys.readouterr().err.count("refused") == 2


def test_examples_with_a_vocabulary(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer(tokenizers.models.BPE())
    own.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    alphabet = tokenizers.pre_tokenizers.ByteLevel.alphabet()
    own.train_from_iterator(["the rows"] * 9, tokenizers.trainers.BpeTrainer(vocab_size=270, initial_alphabet=alphabet, show_progress=False))
    own.add_special_tokens(["<|im_start|>", "<|im_end|>"])
    own.enable_truncation(4)
    own.save(str(tmp_path / "tokenizer.json"))
    own.no_truncation()
    said = [{"role": "user", "content": "count the rows é"}, {"role": "assistant", "content": "the rows 字"}]
    (tmp_path / "sft.jsonl").write_text(json.dumps({"kind": "sft", "sample_id": "a", "n_prefix": 1, "messages": said}) + "\n")
    argv = ["examples", "--sft", str(tmp_path / "sft.jsonl"), "--out", str(tmp_path / "tokens"), "--vocabulary", str(tmp_path / "tokenizer.json")]
    assert cli.main(argv, spark) == 0
    row = spark.read.parquet(str(tmp_path / "tokens")).first()
    texts = [f"<|im_start|>{t['role']}\n{t['content']}<|im_end|>\n" for t in said]
    prompt, whole = (own.encode(x, add_special_tokens=False).ids for x in (texts[0], "".join(texts)))
    assert row.input_ids == whole and row.labels == [-100] * len(prompt) + whole[len(prompt):]
