"""The steps on the command line: `python -m quillspan.cli {cut,roll,filter,pack,gate,recipe,examples} ...`."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import ids
from quillspan.operators import cutting, expand, masks, meters, pairing, sampling
from quillspan.operators.judge import judge, keep_drop_counts, reason_histogram
from quillspan.schema import JUDGED, PREFIX, ROLLOUT, SFT
from quillspan.session import build_session, ship_package
from quillspan.sources import pool, records
from quillspan.sources.chat import ChatPolicy


def _show(name: str, df: DataFrame) -> None:
    """A small aggregate as one line a row."""
    for row in df.collect():
        print(name, *row)


def cut(spark: SparkSession, a: argparse.Namespace) -> int:
    sources = tuple(s.strip() for s in a.sources.split(",") if s.strip())
    entries = cutting.trajectory_entries(pool.read_pool(spark, a.data_root, sources))
    if a.max_scan is not None:
        entries = cutting.pool_head(entries, a.max_scan)
    if entries.isEmpty():
        print("no rows below --data-root/<source>/data/", file=sys.stderr)
        return 2
    picks = sampling.greedy_pick(entries, count=a.count, pack=a.pack, seed=a.seed, repo_cap=a.repo_cap)
    chosen = sampling.picked_prefixes(entries, picks).orderBy("pick_ord").select(*PREFIX.fieldNames())
    records.write_jsonl(chosen.coalesce(1), a.out)  # at most --count rows
    written = records.read_jsonl(spark, a.out, PREFIX)
    n = written.count()
    _show("", meters.counters(written))
    _show("wanted and labelled phase differ:", meters.phase_mismatch(written))
    if n < a.count:
        print(f"short: wanted {a.count}, got {n}", file=sys.stderr)
    return 0


def roll(spark: SparkSession, a: argparse.Namespace) -> int:
    prefixes = records.read_jsonl(spark, a.prefixes, PREFIX)
    i, n = ids.parse_shard(a.shard)
    if n > 1:
        prefixes = sampling.modulo_shard(prefixes, ["sample_id"], i, n)
    if a.backend == "scripted":
        rolled = expand.roll_scripted(prefixes, a.n)
    else:
        policy = ChatPolicy(a.base_url, a.model, a.temperature)
        rolled = expand.roll_with(prefixes, a.n, lambda _rollout: policy, backend=a.backend)
    records.write_jsonl(rolled, a.out)
    return 0


def filter_(spark: SparkSession, a: argparse.Namespace) -> int:
    judged = judge(records.read_jsonl(spark, a.rollouts, ROLLOUT))
    records.write_split(judged.select(*JUDGED.fieldNames()), a.out_dir)
    written = records.read_split(spark, a.out_dir, JUDGED)
    _show("kept and dropped:", keep_drop_counts(written))
    _show("reason:", reason_histogram(written).orderBy(F.desc("n"), "reason"))
    return 0


def pack(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.judged:
        judged = records.read_split(spark, a.judged, JUDGED)
    else:
        judged = records.read_jsonl(spark, [a.rollouts] if a.rollouts else [a.keep, a.drop], JUDGED)
    records.write_jsonl(pairing.sft_rows(judged), f"{a.out_dir}/sft")
    records.write_jsonl(pairing.dpo_rows(judged), f"{a.out_dir}/dpo")
    _show("keeps, pairs, keeps without a pair:", pairing.unpaired_keeps(judged))
    _show("readiness:", pairing.readiness(judged))
    return 0


def gate(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.judged:
        report = meters.meter_report(records.read_split(spark, a.judged, JUDGED))
    elif a.rollouts:
        report = meters.meter_report(judge(records.read_jsonl(spark, a.rollouts, ROLLOUT)))
    else:
        report = {"n": {}, "note": "no rollouts given", "meters": list(V.PASS_IF), "pass_if": V.PASS_IF}
    records.write_report(report, a.out, spark)
    print(json.dumps(report, indent=2))
    return 0


def recipe(_spark: SparkSession | None, a: argparse.Namespace) -> int:
    own = records.recipe(a.base, a.sft, a.dpo, a.out_dir)
    records.write_report(own, f"{a.out_dir}/recipe.json")
    for i, step in enumerate((f"sft: base {own['base']}, data {own['sft']['data']}", f"dpo: base the sft result, data {own['dpo']['data']}, beta {own['dpo']['beta']}", f"merge into {own['adapter_dir']}", "gate on the held-out prefixes"), 1):
        print(f"{i}.", step)
    return 0


def self_test(spark: SparkSession, step: str) -> int:
    """Whether a step gives what it should on one built-in ticket; prints every expectation, 1 if one fails."""
    from quillspan.functions import turns

    def said(command: str) -> str:
        return f"THOUGHT: next\n\n```bash\n{command}\n```"

    commands = ("ls -R cache", "go test ./cache", "head cache/expire.go", "sed -i s/a/b/ cache/expire.go", "go test ./cache", "git diff")
    ticket = [("user", "Entries are kept too long."), *(t for c in commands for t in (("assistant", said(c)), ("user", "done")))]
    one = spark.createDataFrame([(ticket,)], "messages array<struct<role:string,content:string>>")
    messages, expected = F.col("messages"), {}
    if step == "cut":
        expected["first edit"] = (one.select(turns.first_edit_index(messages)).first()[0], 4)
        for index, phase in ((1, "cold"), (2, "cold"), (3, "pre_edit"), (4, "at_edit")):
            cut_there = turns.cut_before(messages, F.lit(index))
            row = one.select(turns.phase_of(cut_there), turns.assistant_count(cut_there)).first()
            expected[f"phase and assistant turns before {index}"] = (tuple(row), (phase, index))
    else:
        head = turns.cut_before(messages, F.lit(2))
        known = {"sample_id": F.lit("self:0:2"), "phase_wanted": F.lit("cold"), "horizon": F.lit(4), "messages": head}
        prefix = one.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PREFIX.fields])
        judged = judge(expand.roll_scripted(prefix, 2))
        rows = {r.rollout: r for r in judged.collect()}
        if step == "roll":
            expected["how rollouts stop"] = ([rows[i].stopped for i in (1, 2)], ["submit", "horizon"])
            expected["commands of rollouts"] = ([len(rows[i].commands) for i in (1, 2)], [3, 4])
        elif step == "filter":
            expected["kept"] = ([rows[i].keep for i in (1, 2)], [True, False])
            expected["reasons"] = (list(rows[2].reasons), ["loop:dup_ratio=0.50", "no_verify_after_edit"])
        else:
            pair = pairing.dpo_rows(judged).collect()
            expected["supervised rows and pairs"] = ((pairing.sft_rows(judged).count(), len(pair)), (1, 1))
            expected["rollouts of the pair"] = ([(p.chosen_rollout, p.rejected_rollout) for p in pair], [(1, 2)])
    for what, (got, want) in expected.items():
        print(f"{what}: {got}" + ("" if got == want else f", expected {want}"))
    good = all(got == want for got, want in expected.values())
    print("PASS" if good else "FAIL")
    return 0 if good else 1


def examples(spark: SparkSession, a: argparse.Namespace) -> int:
    sft = records.read_jsonl(spark, a.sft, SFT)
    tokenize = masks.file_tokenizer(a.vocabulary) if a.vocabulary else masks.blank_tokenizer
    out = masks.sft_examples(sft, tokenize, max_len=a.max_len, drop_fully_masked=a.drop_fully_masked)
    out.write.mode("error").parquet(a.out)
    _show("rows, examples, skipped:", masks.skip_counts(sft, spark.read.parquet(a.out)))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillspan", description=__doc__)
    sub = top.add_subparsers(dest="step", required=True)

    def needs_one(p: argparse.ArgumentParser, *ways: tuple[str, ...]) -> None:
        """Require all options of one of the ways, or `--self-test`."""
        p.add_argument("--self-test", action="store_true", help="check the step on a built-in ticket")
        p.set_defaults(ways=ways)

    p = sub.add_parser("cut", help="trajectories to prefixes")
    p.set_defaults(run=cut)
    needs_one(p, ("data_root", "out"))
    p.add_argument("--data-root")
    p.add_argument("--out")
    p.add_argument("--sources", default=",".join(V.SOURCES))
    p.add_argument("--count", type=int, default=200)
    p.add_argument("--pack", choices=("overfit", "eval"), default="overfit")
    p.add_argument("--seed", default="quillspan")
    p.add_argument("--repo-cap", type=int, default=0, help="0: the pack's own")
    p.add_argument("--max-scan", type=int, help="only this many usable rows, in order")
    p = sub.add_parser("roll", help="prefixes to rollouts")
    p.set_defaults(run=roll)
    needs_one(p, ("prefixes", "out"))
    p.add_argument("--prefixes")
    p.add_argument("--out")
    p.add_argument("--n", type=int, default=4)
    p.add_argument("--backend", choices=("scripted", "chat"), default="scripted")
    p.add_argument("--base-url", default="http://127.0.0.1:8000/v1")
    p.add_argument("--model", default="default")
    p.add_argument("--temperature", type=float, default=1.0)
    p.add_argument("--shard", default="0/1", help="i/n: prefixes at positions i modulo n")
    p = sub.add_parser("filter", help="rollouts to judged rollouts, split by keep")
    p.set_defaults(run=filter_)
    needs_one(p, ("rollouts", "out_dir"))
    p.add_argument("--rollouts")
    p.add_argument("--out-dir")
    p = sub.add_parser("pack", help="judged rollouts to supervised and preference rows")
    p.set_defaults(run=pack)
    needs_one(p, ("judged", "out_dir"), ("rollouts", "out_dir"), ("keep", "drop", "out_dir"))
    p.add_argument("--judged", help="folder written by `filter`")
    p.add_argument("--rollouts", help="judged rollouts, kept and dropped in one file or folder")
    p.add_argument("--keep")
    p.add_argument("--drop")
    p.add_argument("--out-dir")
    p = sub.add_parser("gate", help="rate meters")
    p.set_defaults(run=gate)
    p.add_argument("--run", action="store_true", dest="live", help="refused: no model is rolled here")
    p.add_argument("--judged")
    p.add_argument("--rollouts")
    p.add_argument("--out", required=True)
    p = sub.add_parser("recipe", help="what a training run would read")
    p.set_defaults(run=recipe)
    p.add_argument("--run", action="store_true", dest="live", help="refused: nothing is trained here")
    p.add_argument("--base", required=True)
    p.add_argument("--sft", required=True)
    p.add_argument("--dpo", required=True)
    p.add_argument("--out-dir", required=True)
    p = sub.add_parser("examples", help="supervised rows to masked token rows")
    p.set_defaults(run=examples)
    p.add_argument("--sft", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--vocabulary", help="tokenizer.json to encode with; without it words stand in for tokens, for size estimates only")
    p.add_argument("--max-len", type=int, default=8192)
    p.add_argument("--drop-fully-masked", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if getattr(a, "live", False):
        print("refused: this program prepares data only", file=sys.stderr)
        return 2
    ways = getattr(a, "ways", ((),))
    if not getattr(a, "self_test", False) and not any(all(getattr(a, name) for name in way) for way in ways):
        needed = " or ".join(" ".join(f"--{name.replace('_', '-')}" for name in way) for way in ways)
        print(f"{a.step}: needs {needed}", file=sys.stderr)
        return 2
    if a.step != "recipe":
        spark = spark or build_session()
        ship_package(spark)
    return self_test(spark, a.step) if getattr(a, "self_test", False) else a.run(spark, a)


if __name__ == "__main__":
    raise SystemExit(main())
