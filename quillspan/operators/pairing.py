"""Supervised rows, preference pairs and readiness of a judged set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import turns
from quillspan.operators.ordinals import with_ordinal
from quillspan.schema import TURNS
from quillspan.session import cut_lineage


def sft_rows(judged: DataFrame) -> DataFrame:
    """Every kept rollout as a supervised row; `n_prefix` is the length of its prefix."""
    prefix = turns.prefix_of(F.col("messages"), F.col("continuation"))
    return judged.where("keep").select(
        F.lit("sft").alias("kind"), "sample_id", "phase_wanted", F.size(prefix).alias("n_prefix"), "messages"
    )


def pair_keys(judged: DataFrame) -> DataFrame:
    """(sample_id, k, chosen_rollout, rejected_rollout): the k-th keep with the k-th drop of a sample.

    Both sides are ranked by rollout.  Only narrow columns are read, once; a sample of any
    number of rollouts is ranked over range partitions.  Rows with a null sample_id form one
    group, as in a dict.
    """
    ranked = _ranked(judged.select("sample_id", "keep", "rollout"))
    paired = ranked.groupBy("sample_id", "k").agg(
        F.max(F.when(F.col("keep"), F.col("rollout"))).alias("chosen_rollout"),
        F.max(F.when(~F.col("keep"), F.col("rollout"))).alias("rejected_rollout"),
    )
    return paired.where("chosen_rollout is not null and rejected_rollout is not null")


def _ranked(verdicts: DataFrame) -> DataFrame:
    """Add `k`: the place, from 1, of a rollout among those of its sample and verdict."""
    verdicts = cut_lineage(verdicts)  # judged once, although range partitions sample their input
    at = with_ordinal(verdicts, ["sample_id", "keep", "rollout"], "__at", within=["sample_id", "keep"])
    return at.withColumn("k", (F.col("__at") + 1).cast("int")).drop("__at")


def dpo_rows(judged: DataFrame) -> DataFrame:
    """Preference rows: positional pairs of keeps and drops of a sample, leftovers unpaired.

    (sample_id, rollout) must identify rows; a null sample_id is a sample of its own.
    Verdicts are computed once, as narrow rows.  The turn arrays are read once, for both
    sides, and only those of paired rollouts move, each to its (sample, k).
    """
    ranked = _ranked(judged.select("sample_id", "keep", "rollout", "reasons"))
    both = F.count_if("keep").over(Window.partitionBy("sample_id", "k")) == 1
    both = both & (F.count_if(~F.col("keep")).over(Window.partitionBy("sample_id", "k")) == 1)
    sides = ranked.withColumn("__both", both).where("__both").drop("__both")
    wide = judged.select(F.col("sample_id").alias("__s"), F.col("rollout").alias("__r"), "phase_wanted", "messages", "continuation")
    same = F.col("sample_id").eqNullSafe(F.col("__s")) & F.col("rollout").eqNullSafe(F.col("__r"))
    told = sides.join(wide, same)
    empty = F.array().cast(TURNS)
    said = F.struct(
        "rollout",
        F.coalesce("continuation", empty).alias("said"),
        F.when(F.col("keep"), turns.prefix_of(F.col("messages"), F.col("continuation"))).alias("prompt"),
        F.when(F.col("keep"), F.col("phase_wanted")).alias("phase_wanted"),
        F.when(~F.col("keep"), F.col("reasons")).alias("reasons"),
    )
    paired = told.groupBy("sample_id", "k").agg(
        F.first(F.when(F.col("keep"), said), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("keep"), said), ignorenulls=True).alias("b"),
    )
    return paired.select(
        F.lit("dpo").alias("kind"),
        "sample_id",
        F.col("a.phase_wanted").alias("phase_wanted"),
        F.col("a.prompt").alias("prompt"),
        F.col("a.said").alias("chosen"),
        F.col("b.said").alias("rejected"),
        F.col("a.rollout").alias("chosen_rollout"),
        F.col("b.rollout").alias("rejected_rollout"),
        F.col("b.reasons").alias("rejected_reasons"),
    )


def _per_sample(judged: DataFrame) -> DataFrame:
    return judged.groupBy("sample_id").agg(
        F.count_if("keep").alias("keeps"), F.count_if("drop").alias("drops")
    )


def unpaired_keeps(judged: DataFrame) -> DataFrame:
    """One row: n_keep, n_pair and n_unpaired = n_keep - n_pair."""
    per = _per_sample(judged)
    total = per.agg(
        F.coalesce(F.sum("keeps"), F.lit(0)).alias("n_keep"),
        F.coalesce(F.sum(F.least("keeps", "drops")), F.lit(0)).alias("n_pair"),
    )
    return total.withColumn("n_unpaired", F.col("n_keep") - F.col("n_pair"))


def ready_tickets(judged: DataFrame) -> DataFrame:
    """(sample_id, keeps, drops, state): both, all_keep or all_drop."""
    state = F.when(F.col("drops") == 0, "all_keep").when(F.col("keeps") == 0, "all_drop").otherwise("both")
    return _per_sample(judged).withColumn("state", state)


def readiness(judged: DataFrame, keep_bar: int = V.KEEP_BAR, ticket_bar: int = V.TICKET_BAR) -> DataFrame:
    """One row: counts of keeps and of tickets by state, and whether both bars are met."""
    counts = ready_tickets(judged).agg(
        F.coalesce(F.sum("keeps"), F.lit(0)).alias("n_keep"),
        F.count_if(F.col("state") == "both").alias("n_both"),
        F.count_if(F.col("state") == "all_keep").alias("n_all_keep"),
        F.count_if(F.col("state") == "all_drop").alias("n_all_drop"),
    )
    return counts.withColumn("ready", (F.col("n_keep") >= keep_bar) & (F.col("n_both") >= ticket_bar))


def usable_dpo(dpo: DataFrame) -> DataFrame:
    """prompt, chosen and rejected of the rows in which none of the three is null or empty."""
    names = ("prompt", "chosen", "rejected")
    ok = F.lit(True)
    for n in names:
        ok = ok & (F.coalesce(F.size(n), F.lit(0)) > 0)
    return dpo.where(ok).select(*names)
