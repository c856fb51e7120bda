"""Ordered keep/drop rules over rollouts: a narrow, shuffle-free stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import detect, text, turns
from quillspan.schema import truthy


def _two_decimals() -> dict[int, str]:
    """Python's rendering of the ratios that lie exactly between two hundredths, by ratio * 200.

    Java rounds these by their decimal form, Python by the exact value of the double.
    """
    return {m: f"{1 - (200 - m) / 200:.2f}" for m in range(1, 200, 2)}


def ratio_text(commands: Column, ratio: Column) -> Column:
    """The duplicate ratio of `commands` with two decimals, rounded as Python formats it."""
    n = F.size(commands)
    twice = (n - F.size(F.array_distinct(commands))) * 200
    ties = F.create_map(*[F.lit(x) for item in _two_decimals().items() for x in item])
    between = F.when(F.pmod(twice, n) == 0, F.try_element_at(ties, F.floor(twice / n).cast("int")))
    return F.coalesce(between, F.format_string("%.2f", ratio))


def loop_reason(commands: Column) -> Column:
    """`loop:<k>x same command` or `loop:dup_ratio=<r>` over the commands that do not submit, else null."""
    work = F.filter(commands, lambda c: ~text.is_submit(c))
    run, ratio = turns.longest_equal_run(work), turns.duplicate_ratio(work)
    return F.when(
        run >= V.MAX_RUN, F.concat(F.lit("loop:"), run.cast("string"), F.lit("x same command"))
    ).when(ratio >= V.DUP_RATIO, F.concat(F.lit("loop:dup_ratio="), ratio_text(work, ratio)))


def _count(flags: Column) -> Column:
    return F.size(F.filter(flags, lambda f: f))


def _any(flags: Column) -> Column:
    return F.exists(flags, lambda f: f)


def judge(rollouts: DataFrame) -> DataFrame:
    """All columns of `rollouts` plus keep, drop and reasons (in rule order; keep = no reasons).

    Uses phase_wanted (null and empty count as cold), stopped, messages and continuation
    (null counts as empty); other columns pass through.  Commands are taken from the turns
    again, without empty ones, not from the stored `commands`.
    """
    cont, pre = "__cont", "__pre"
    df = rollouts.withColumn(cont, turns.commands_of(F.col("continuation"))).withColumn(
        pre, turns.commands_of(turns.prefix_of(F.col("messages"), F.col("continuation")))
    )
    df = df.withColumns(
        {
            "__phase": F.coalesce(truthy("phase_wanted"), F.lit("cold")),
            "__stopped": F.coalesce(F.col("stopped"), F.lit("")),
            "__edit": F.transform(cont, detect.is_edit),
            "__verify": F.transform(cont, detect.is_verify),
            "__claim": F.transform(cont, detect.is_claim),
            "__wide": F.transform(cont, detect.is_wide_search),
            "__infra": F.transform(cont, detect.is_infra),
            "__submits": F.exists(cont, text.is_submit),
            "__pre_edit": F.exists(pre, detect.is_edit),
            "__pre_claim": F.exists(pre, detect.is_claim),
            "__loop": loop_reason(F.col(cont)),
        }
    )
    n = F.size(cont)
    back = F.array_position(F.reverse(F.col("__edit")), F.lit(True)).cast("int")
    df = df.withColumn("__last", F.when(back > 0, n - back))  # 0-based, null without an edit
    last = F.col("__last")
    after = F.slice("__verify", F.coalesce(last, F.lit(0)) + 2, n)
    before = F.slice("__claim", F.lit(1), F.coalesce(last, F.lit(0)))
    phase = F.col("__phase")
    unverified = F.when(last.isNotNull(), ~_any(after)).otherwise(
        F.col("__pre_edit") & (phase == "at_edit") & ~_any(F.col("__verify"))
    )
    df = df.withColumn("__unverified", unverified)
    rules = (
        (F.startswith("__stopped", F.lit("bad_turn")), F.col("__stopped")),
        (F.col("__loop").isNotNull(), F.col("__loop")),
        (phase.isin("cold", "pre_edit") & last.isNull(), F.lit("no_source_edit")),
        ((phase == "pre_edit") & F.coalesce(F.get("__wide", F.lit(0)), F.lit(False)), F.lit("restart_wide_search")),
        (
            phase.isin("pre_edit", "at_edit") & (_count(F.col("__wide")) >= V.WIDE_SEARCH_LIMIT),
            F.lit("search_spam"),
        ),
        (_count(F.col("__infra")) >= V.INFRA_LIMIT, F.lit("infra_thrash")),
        (F.col("__unverified"), F.lit("no_verify_after_edit")),
        (
            last.isNotNull() & (phase == "cold") & ~(F.col("__pre_claim") | _any(before)),
            F.lit("edit_before_repro"),
        ),
        (F.col("__submits") & F.col("__unverified"), F.lit("submit_without_verify")),
    )
    reasons = F.array_compact(F.array(*[F.when(condition, name) for condition, name in rules]))
    kept = [c for c in rollouts.columns if c not in ("keep", "drop", "reasons")]
    return df.select(*kept, reasons.alias("reasons")).select(
        *kept, (F.size("reasons") == 0).alias("keep"), (F.size("reasons") > 0).alias("drop"), "reasons"
    )


def reason_histogram(judged: DataFrame) -> DataFrame:
    """(reason, n) over dropped rows; a row counts once for each of its reasons."""
    dropped = judged.where("drop").select(F.explode("reasons").alias("reason"))
    return dropped.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def keep_drop_counts(judged: DataFrame) -> DataFrame:
    """One row: n_keep, n_drop."""
    return judged.agg(F.count_if("keep").alias("n_keep"), F.count_if("drop").alias("n_drop"))
