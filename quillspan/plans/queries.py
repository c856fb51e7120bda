"""One query per operator over the tables trajectories, prefixes, rollouts and dpo.

Arrays are reduced to scalars in the results so that any SQL engine can produce the same
rows; counts are 64-bit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import detect, ids, text, turns
from quillspan.operators import cutting, expand, masks, meters, pairing, sampling
from quillspan.operators.judge import judge, keep_drop_counts, reason_histogram
from quillspan.operators.latest import latest
from quillspan.plans import cases
from quillspan.plans.tables import table
from quillspan.schema import JUDGED, PREFIX, ROLLOUT, TRAJECTORY, normalized_turns
from quillspan.session import ensure_checkpoint_dir, spread
from quillspan.sources import pool, records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROLLOUT_KEY = ["sample_id", "rollout"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _count(name: str):
    return F.count(F.lit(1)).alias(name)


# --- trajectories ---------------------------------------------------------------------


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return cutting.trajectory_entries(spread(table(spark, d, "trajectories")))


@query
def trajectory_entries(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).drop("messages")


@query
def first_edit_turn(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "trajectories")
    found = turns.first_edit_index(normalized_turns(raw))
    return raw.select("shard", "row_in_shard", found.alias("detected_edit"), "first_edit")


@query
def assistant_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "trajectories")
    return raw.select("shard", "row_in_shard", turns.assistant_count(normalized_turns(raw)).alias("asst"))


def _cut(phase: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        cutd = cutting.cut(_entries(spark, d), phase)
        records = cutting.prefix_records(cutd, phase, F.lit(V.DEFAULT_HORIZON))
        return records.withColumn("n_turns", F.size("messages")).drop("messages")

    return run


for _phase in V.PHASES:
    QUERIES[f"cut_{_phase}"] = _cut(_phase)


@query
def prefix_phase_label(spark: SparkSession, d: str) -> DataFrame:
    label = turns.phase_of(F.col("messages"))
    return table(spark, d, "prefixes").groupBy(label.alias("label")).agg(_count("n"))


@query
def cuttable_counts(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.pick_candidates(_entries(spark, d), "seed")
    return out.groupBy("source").agg(
        *[F.count_if(c).alias(f"n_{c}") for c in ("can_cold", "can_pre_edit", "can_at_edit")]
    )


@query
def cold_pick_parity(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "trajectories").select("instance_id").where("instance_id is not null").distinct()
    return out.withColumn("pick", ids.cold_pick(F.col("instance_id")))


@query
def family_language(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "trajectories").where("instance_id <> ''")
    iid, source = F.col("instance_id"), F.col("source")
    return out.select(
        "instance_id",
        "source",
        ids.family_of(iid, source).alias("derived_family"),
        ids.language_of(F.col("language"), source).alias("own_language"),
        ids.repo_of(F.col("repo"), iid).alias("own_repo"),
    ).distinct()


@query
def pool_head(spark: SparkSession, d: str) -> DataFrame:
    return cutting.pool_head(_entries(spark, d).drop("messages"), 100)


@query
def leak_anti_join(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "prefixes").where("split = 'test'").select("source", "instance_id")
    kept = cutting.without_leaks(table(spark, d, "trajectories"), held)
    return kept.groupBy("source").agg(_count("n"))


@query
def greedy_pick(spark: SparkSession, d: str) -> DataFrame:
    entries = _entries(spark, d)
    picks = sampling.greedy_pick(entries, count=100)
    return sampling.picked_prefixes(entries, picks).withColumn("n_turns", F.size("messages")).drop("messages")


# --- prefixes -------------------------------------------------------------------------


def _prefixes(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return latest(table(spark, d, "prefixes").select("sample_id", *columns, "loaded_at"), ["sample_id"]).drop(
        "loaded_at"
    )


@query
def prefix_counters(spark: SparkSession, d: str) -> DataFrame:
    return meters.counters(table(spark, d, "prefixes"))


@query
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prefixes").groupBy("source").agg(_count("n"))


@query
def phase_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return meters.phase_mismatch(table(spark, d, "prefixes"))


@query
def repo_cap(spark: SparkSession, d: str) -> DataFrame:
    rows = _prefixes(spark, d, "repo")
    return sampling.cap_per_group(rows, "repo", 2, ["sample_id"])


@query
def head_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.head_split(_prefixes(spark, d), ["sample_id"])


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_split(_prefixes(spark, d, "source"), ["source"], ["sample_id"], 0.25)


@query
def disjoint_train(spark: SparkSession, d: str) -> DataFrame:
    rows = _prefixes(spark, d, "instance_id", "repo", "split")
    held = rows.where("split in ('validation', 'test')")
    return sampling.disjoint_from(rows.where("split = 'train'"), held, ["instance_id"]).select("sample_id")


@query
def modulo_shard(spark: SparkSession, d: str) -> DataFrame:
    return sampling.modulo_shard(_prefixes(spark, d), ["sample_id"], 1, 4)


@query
def apportion_quota(spark: SparkSession, _d: str) -> DataFrame:
    rows = [
        ("phase", name, n) for name, n in sampling.apportion(V.OVERFIT_PHASE_SHARES, 340).items()
    ] + [("source", name, n) for name, n in sampling.apportion(V.OVERFIT_SOURCE_SHARES, 340).items()]
    return spark.createDataFrame(rows, "what string, name string, want bigint")


@query
def expand_rollouts(spark: SparkSession, d: str) -> DataFrame:
    return expand.fan_out(_prefixes(spark, d, "horizon"), 6)


def _rolled(rolled: DataFrame) -> DataFrame:
    return rolled.select(
        "sample_id",
        "rollout",
        "stopped",
        F.array_join("commands", "\n").alias("commands"),
        F.size("messages").alias("n_messages"),
        F.element_at("continuation", -1)["content"].alias("last_turn"),
    )


def _to_roll(spark: SparkSession, d: str) -> DataFrame:
    return _prefixes(spark, d, "phase_wanted", "source", "instance_id", "horizon", "messages")


@query
def scripted_rollouts(spark: SparkSession, d: str) -> DataFrame:
    return _rolled(expand.roll_scripted(_to_roll(spark, d), 4))


@query
def policy_rollouts(spark: SparkSession, d: str) -> DataFrame:
    def policy_for(rollout: int) -> expand.Policy:
        return expand.verifying_policy if rollout % 2 else expand.skipping_policy

    return _rolled(expand.roll_with(_to_roll(spark, d), 4, policy_for))


@query
def user_query_filter(spark: SparkSession, d: str) -> DataFrame:
    asks = masks.has_user_query(F.col("messages"))
    return table(spark, d, "prefixes").groupBy(asks.alias("asks")).agg(_count("n"))


@query
def rendered_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocks = masks.rendered_blocks_before(F.col("messages"), F.lit(5))
    return table(spark, d, "prefixes").select("sample_id", "loaded_at", blocks.alias("blocks"))


# --- rollouts -------------------------------------------------------------------------


@query
def extract_command(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "rollouts").select(
        *ROLLOUT_KEY, "loaded_at", F.posexplode(turns.assistant_contents(F.col("continuation"))).alias("turn", "said")
    )
    said = F.col("said")
    return rows.select(
        *ROLLOUT_KEY,
        "loaded_at",
        "turn",
        text.first_command(said).alias("command"),
        text.unusable_reason(said).alias("why"),
        text.is_submit(text.first_command(said)).alias("submits"),
    )


@query
def usable_turns(spark: SparkSession, d: str) -> DataFrame:
    said = F.explode(turns.assistant_contents(F.col("continuation")))
    rows = table(spark, d, "rollouts").select(said.alias("said"))
    return rows.groupBy(text.unusable_reason(F.col("said")).alias("why")).agg(_count("n"))


def _commands(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "rollouts")
    return rows.select(*ROLLOUT_KEY, "source", "loaded_at", F.posexplode("commands").alias("pos", "command"))


@query
def submit_turns(spark: SparkSession, d: str) -> DataFrame:
    return _commands(spark, d).where(text.is_submit(F.col("command"))).select(*ROLLOUT_KEY, "loaded_at", "pos")


@query
def observed_commands(spark: SparkSession, d: str) -> DataFrame:
    seen = text.stub_observation(F.col("command")).alias("seen")
    return _commands(spark, d).where("command is not null").select(seen).distinct()


def _event(test) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _commands(spark, d)
        return rows.where(test(F.col("command"))).select(*ROLLOUT_KEY, "loaded_at", "pos")

    return run


QUERIES |= {
    "edit_commands": _event(detect.is_edit),
    "verify_commands": _event(detect.is_verify),
    "claims_commands": _event(detect.is_claim),
    "wide_search_commands": _event(detect.is_wide_search),
    "infra_commands": _event(detect.is_infra),
}


def _work(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "rollouts").select(*ROLLOUT_KEY, "loaded_at", "continuation")
    return rows.withColumn("cmds", turns.commands_of(F.col("continuation"))).drop("continuation")


@query
def longest_run(spark: SparkSession, d: str) -> DataFrame:
    run = turns.longest_equal_run(F.col("cmds"))
    return _work(spark, d).select(*ROLLOUT_KEY, "loaded_at", run.alias("longest"))


@query
def dup_ratio(spark: SparkSession, d: str) -> DataFrame:
    ratio = turns.duplicate_ratio(F.col("cmds"))
    return _work(spark, d).select(*ROLLOUT_KEY, "loaded_at", F.round(ratio, 6).alias("ratio"))


_JUDGED_INPUT = ("phase_wanted", "stopped", "messages", "continuation", "commands")


def _judged(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Judged rollouts, one per key: the rules run first, so only what `columns` name moves."""
    raw = spread(table(spark, d, "rollouts").select(*ROLLOUT_KEY, "loaded_at", *_JUDGED_INPUT))
    return latest(judge(raw).select(*ROLLOUT_KEY, "loaded_at", "keep", "drop", "reasons", *columns), ROLLOUT_KEY)


@query
def judge_reasons(spark: SparkSession, d: str) -> DataFrame:
    raw = spread(table(spark, d, "rollouts").select(*ROLLOUT_KEY, "loaded_at", *_JUDGED_INPUT))
    return judge(raw).select(*ROLLOUT_KEY, "loaded_at", "keep", F.array_join("reasons", "|").alias("reasons"))


@query
def keep_drop(spark: SparkSession, d: str) -> DataFrame:
    return keep_drop_counts(_judged(spark, d))


@query
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return reason_histogram(_judged(spark, d))


@query
def sft_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = pairing.sft_rows(_judged(spark, d, "phase_wanted", "messages", "continuation"))
    return rows.withColumn("n_messages", F.size("messages")).drop("messages")


@query
def dpo_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = pairing.dpo_rows(_judged(spark, d, "phase_wanted", "messages", "continuation"))
    return rows.select(
        "kind",
        "sample_id",
        "phase_wanted",
        "chosen_rollout",
        "rejected_rollout",
        F.array_join("rejected_reasons", "|").alias("rejected_reasons"),
        *[F.size(c).alias(f"n_{c}") for c in ("prompt", "chosen", "rejected")],
    )


@query
def unpaired_keeps(spark: SparkSession, d: str) -> DataFrame:
    return pairing.unpaired_keeps(_judged(spark, d))


@query
def ready_tickets(spark: SparkSession, d: str) -> DataFrame:
    return pairing.ready_tickets(_judged(spark, d))


@query
def readiness(spark: SparkSession, d: str) -> DataFrame:
    return pairing.readiness(_judged(spark, d))


@query
def meter_rates(spark: SparkSession, d: str) -> DataFrame:
    out = meters.meter_rates(_judged(spark, d, "phase_wanted", "commands"), at_edit=True)
    return out.select(*[F.round(c, 9).alias(c) if c.endswith(("rate", "wide")) else F.col(c) for c in out.columns])


@query
def phase_counts(spark: SparkSession, d: str) -> DataFrame:
    return meters.phase_counts(_judged(spark, d, "phase_wanted"))


def _sft(spark: SparkSession, d: str) -> DataFrame:
    raw = spread(table(spark, d, "rollouts").select(*ROLLOUT_KEY, "loaded_at", "messages", "continuation"))
    prefix = turns.prefix_of(F.col("messages"), F.col("continuation"))
    return raw.select(*ROLLOUT_KEY, "loaded_at", F.size(prefix).alias("n_prefix"), "messages")


@query
def span_mask(spark: SparkSession, d: str) -> DataFrame:
    plan = masks.loss_plan(F.col("messages"), F.col("n_prefix"))
    rows = _sft(spark, d).select(
        *ROLLOUT_KEY, "loaded_at", F.length(masks.render(F.col("messages"))).alias("chars"), plan.alias("plan")
    )
    learned = F.aggregate("plan.spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"])
    return rows.select(
        *ROLLOUT_KEY, "loaded_at", "chars", F.col("plan.cut").alias("cut"), learned.alias("learned")
    )


def _examples(spark: SparkSession, d: str, **limit: int) -> DataFrame:
    return masks.sft_examples(_sft(spark, d), keep=("sample_id", "rollout", "loaded_at"), **limit)


def _lengths(examples: DataFrame) -> DataFrame:
    learned = F.size(F.filter("labels", lambda x: x != V.IGNORE_LABEL))
    return examples.select(*ROLLOUT_KEY, "loaded_at", F.size("input_ids").alias("n"), learned.alias("learned"))


def _batches(examples: DataFrame) -> DataFrame:
    out = masks.padded(examples, "sample_id", 0)
    return out.groupBy("sample_id").agg(
        F.min(F.size("input_ids")).alias("shortest"),
        F.max(F.size("labels")).alias("longest"),
        F.sum(F.size(F.filter("attention_mask", lambda x: x == 0))).alias("pads"),
    )


@query
def sft_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Cut at 512, as its SQL is."""
    return _lengths(_examples(spark, d, max_len=512))


@query
def sft_tokens_long(spark: SparkSession, d: str) -> DataFrame:
    """At the operator's and the command line's length."""
    return _lengths(_examples(spark, d))


@query
def pad_batch(spark: SparkSession, d: str) -> DataFrame:
    """Cut at 512, as its SQL is."""
    return _batches(_examples(spark, d, max_len=512))


@query
def pad_batch_long(spark: SparkSession, d: str) -> DataFrame:
    """At the operator's and the command line's length."""
    return _batches(_examples(spark, d))


@query
def pad_rows(spark: SparkSession, d: str) -> DataFrame:
    """Batches of eight examples each, in the order of their keys, padded."""
    batches = masks.batched(_examples(spark, d), [*ROLLOUT_KEY, "loaded_at"], 8)
    return masks.padded(batches, "batch", 0).groupBy("batch").agg(
        _count("rows"), F.min(F.size("input_ids")).alias("shortest"), F.max(F.size("labels")).alias("longest"),
        F.sum(F.size(F.filter("attention_mask", lambda x: x == 0))).alias("pads"),
    )


@query
def skipped_examples(spark: SparkSession, d: str) -> DataFrame:
    """Rows and examples at the operator's length, and the difference."""
    return masks.skip_counts(_sft(spark, d), _examples(spark, d))


# --- built-in cases and files ------------------------------------------------------------


@query
def detector_cases(spark: SparkSession, _d: str) -> DataFrame:
    """Every detector on commands that set it off and on near misses."""
    rows = spark.createDataFrame(list(enumerate(cases.COMMANDS)), "id int, c string")
    c = F.col("c")
    return rows.select(
        "id",
        detect.is_edit(c).alias("edit"),
        detect.is_verify(c).alias("verify"),
        detect.is_claim(c).alias("claim"),
        detect.is_wide_search(c).alias("wide"),
        detect.is_infra(c).alias("infra"),
        text.is_submit(c).alias("submit"),
    )


@query
def rule_cases(spark: SparkSession, _d: str) -> DataFrame:
    """Every rule of the judge on rollouts that break it and on near misses."""
    names = [f.name for f in ROLLOUT.fields if f.name in cases.Rollout._fields]
    rows = [tuple(getattr(r, f.name, None) for f in ROLLOUT.fields) for r in cases.ROLLOUTS]
    judged = judge(spark.createDataFrame(rows, ROLLOUT).select(*names))
    return judged.select(*ROLLOUT_KEY, "keep", F.array_join("reasons", "|").alias("reasons"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Prefix records written as JSON Lines and read again."""
    path = _folder(spark, "prefixes")
    records.write_jsonl(table(spark, d, "prefixes").select(*PREFIX.fieldNames()), path)
    said = F.transform("messages", lambda m: F.concat(F.coalesce(m["role"], F.lit("-")), F.lit(":"), F.coalesce(m["content"], F.lit("-"))))
    return records.read_jsonl(spark, path, PREFIX).select(
        *[c for c in PREFIX.fieldNames() if c not in ("asst_in_row", "asst_in_prefix", "messages")],
        F.when(F.col("messages").isNotNull(), F.size("messages")).alias("n_turns"),
        F.md5(F.array_join(said, "|")).alias("said"),
    )


@query
def split_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Judged rollouts written as kept and dropped ones and read again, each side from its folder."""
    path = _folder(spark, "judged")
    wide = [c for c in JUDGED.fieldNames() if c not in (*ROLLOUT_KEY, "keep", "drop", "reasons")]
    raw = table(spark, d, "rollouts").select(*ROLLOUT_KEY, *wide, "loaded_at")
    records.write_split(latest(judge(raw), ROLLOUT_KEY).select(*JUDGED.fieldNames()), path)
    sides = [records.read_split(spark, path, JUDGED, keep) for keep in (True, False)]
    return sides[0].union(sides[1]).select(
        *ROLLOUT_KEY, "keep", F.size("reasons").alias("n_reasons"), F.when(F.col("messages").isNotNull(), F.size("messages")).alias("n_messages")
    )


@query
def pool_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Trajectories written as one folder of shards per source and read again as a pool of sources."""
    root, rows = _folder(spark, "pool"), table(spark, d, "trajectories")
    for source in V.SOURCES:
        own = rows.where(F.col("source") == source).select(*TRAJECTORY.fieldNames())
        own.write.parquet(f"{root}/{source}/data")
    found = reduce(DataFrame.unionByName, [pool.read_source(spark, root, s, "part-*.parquet") for s in V.SOURCES])
    return found.groupBy("source").agg(
        _count("n"), F.sum(F.when(F.col("messages").isNotNull(), F.size("messages"))).alias("n_turns"), F.count_distinct("instance_id").alias("n_instances")
    )


@query
def dpo_usable(spark: SparkSession, d: str) -> DataFrame:
    rows = pairing.usable_dpo(table(spark, d, "dpo"))
    return rows.select(*[F.size(c).alias(f"n_{c}") for c in rows.columns])


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Judged rollouts to preference pairs: the pipeline's main path."""
    return dpo_pairs(spark, d)
