"""Rate meters over judged rollouts and counters over prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import detect
from quillspan.schema import truthy


def _rate(hit: Column, of: Column) -> Column:
    return F.try_divide(F.count_if(hit & of).cast("double"), F.count_if(of))


def meter_rates(judged: DataFrame, at_edit: bool = False) -> DataFrame:
    """One row of counts and rates over stored `commands`; a rate is null without rows of its phase.

    Null commands count as none, null and empty phases as cold.  `at_edit` adds a rate
    of checks among at_edit rollouts, which has no bar.
    """
    commands = F.coalesce("commands", F.array().cast("array<string>"))
    flags = judged.select(
        F.coalesce(truthy("phase_wanted"), F.lit("cold")).alias("phase"),
        F.exists("reasons", lambda r: F.startswith(r, F.lit("loop:"))).alias("loop"),
        F.array_contains("reasons", "no_verify_after_edit").alias("unverified"),
        F.exists(commands, detect.is_edit).alias("edit"),
        F.exists(commands, detect.is_verify).alias("verify"),
        F.coalesce(F.get(commands, F.lit(0)), F.lit("")).alias("first"),
    )
    cold, pre, late = (F.col("phase") == p for p in ("cold", "pre_edit", "at_edit"))
    focused = (F.col("first") != "") & ~detect.is_wide_search(F.col("first"))
    rates = [
        F.count_if(cold).alias("n_cold"),
        F.count_if(pre).alias("n_pre_edit"),
        F.count(F.lit(1)).alias("n_all"),
        _rate(~F.col("unverified") & F.col("verify"), cold).alias("cold_verify_rate"),
        _rate(F.col("edit"), cold).alias("cold_edit_rate"),
        _rate(focused, pre).alias("pre_edit_no_wide"),
        _rate(F.col("edit"), pre).alias("pre_edit_edit_rate"),
        _rate(F.col("loop"), F.lit(True)).alias("loop_rate"),
    ]
    if at_edit:
        rates.append(_rate(F.col("verify"), late).alias("at_edit_verify_rate"))
    return flags.agg(*rates)


def phase_counts(judged: DataFrame) -> DataFrame:
    """(phase, n) for every phase seen, null and empty as cold."""
    phase = F.coalesce(truthy("phase_wanted"), F.lit("cold")).alias("phase")
    return judged.groupBy(phase).agg(F.count(F.lit(1)).alias("n"))


def meter_report(judged: DataFrame) -> dict:
    """The report as a dict: counts by phase (bounded by the phases), rates and pass conditions."""
    counts = {"cold": 0, "pre_edit": 0, "all": 0}
    row = meter_rates(judged).first().asDict()
    counts["all"] = row["n_all"]
    counts |= {r["phase"]: r["n"] for r in phase_counts(judged).toLocalIterator()}
    rates = {k: v for k, v in row.items() if not k.startswith("n_")}
    return {"n": counts} | rates | {"pass_if": V.PASS_IF}


def counters(prefixes: DataFrame) -> DataFrame:
    """(what, value, n): rows by phase_wanted, source, family and phase_labeled, in one pass."""
    names = ("phase_wanted", "source", "family", "phase_labeled")
    pairs = F.array(*[F.struct(F.lit(n).alias("what"), F.col(n).alias("value")) for n in names])
    return prefixes.select(F.inline(pairs)).groupBy("what", "value").agg(F.count(F.lit(1)).alias("n"))


def phase_mismatch(prefixes: DataFrame) -> DataFrame:
    """One row: n_rows and n_mismatch, rows whose wanted and labelled phases differ (null differs from a value)."""
    differs = ~F.col("phase_wanted").eqNullSafe(F.col("phase_labeled"))
    return prefixes.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_mismatch"))
