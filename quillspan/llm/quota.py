"""Problem 5: a sample that follows target proportions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspan.session import cut_lineage

SAMPLE_SHARE = 5
BUCKETS = 4096
_UNIT = float(1 << 53)


def label_key(label: Column) -> Column:
    """What is left of a label without case, blanks and punctuation: notations of one name share it."""
    return F.regexp_replace(F.lower(label), "[^a-z0-9]", "")


def spelled(label: Column, names: tuple[str, ...]) -> Column:
    """A label as in `names` if it is one of them in any notation, else its letters and digits in lower case.

    Letters of any script count; a label without any keeps its characters; null stays null.
    """
    key = F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]", "")
    out = F.when(key == "", F.trim(label)).otherwise(key)
    for name in names:
        out = F.when(key == label_key(F.lit(name)), F.lit(name)).otherwise(out)
    return out


def _unit(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") / F.lit(_UNIT)


@dataclass(frozen=True)
class QuotaSample:
    """`sample`: (key, cells...); `cells`: each target cell with target, available, drawn and deficit."""

    sample: DataFrame
    cells: DataFrame


def labelled(df: DataFrame, targets: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """Distinct (key, labels...) of the rows whose labels all name a target cell's, spelled as in `targets`.

    A row counts if each of its labels names a value of that column of `targets`, in any
    notation, even if the combination is no cell; rows with a null key do not count.
    Targets are few (checked to be at most 10,000) and broadcast.
    """
    if targets.limit(10_001).count() > 10_000:
        raise ValueError("more than 10,000 target cells")
    out = df.where(F.col(key).isNotNull()).select(
        key, *[label_key(F.col(c)).alias(f"__{c}") for c in labels]
    )
    for c in labels:
        names = targets.select(label_key(F.col(c)).alias(f"__{c}"), F.col(c)).where(F.col(c).isNotNull())
        out = out.join(F.broadcast(names.dropDuplicates([f"__{c}"])), f"__{c}")
    return out.select(key, *labels).distinct()


def quota_sample(
    df: DataFrame,
    targets: DataFrame,
    key: str,
    labels: list[str],
    seed: str = "quota",
    sample_share: int = SAMPLE_SHARE,
) -> QuotaSample:
    """Draw distinct keys so that cell c gets max(min_rows, share * N / sample_share) of them.

    N is the number of distinct keys with known labels (see `labelled`).  The wanted number
    is not rounded for the question whether a cell can be met; the drawn number is its
    ceiling.  A cell with fewer keys gives all of them and reports a deficit.  A key with
    labels of several cells counts as available in each and may be drawn for each.

    Acceptance: each key is accepted independently with probability target / available
    plus a margin of six standard deviations and a little, by a hash of seed and key.  The
    surplus is cut exactly: counts per narrow hash interval give the interval in which a
    cell's quota ends, and only the keys in it are ranked.  Should a draw come out short,
    its cell's probability becomes 1.  Cells of any size stay spread over all tasks; an
    empty table gives an empty sample and deficits in every cell.
    """
    pool = cut_lineage(labelled(df, targets, key, labels))
    total = pool.select(key).distinct().count()
    observed = pool.groupBy(*labels).agg(F.count(F.lit(1)).alias("available"))
    exact = F.col("share").cast("decimal(18,12)") * F.lit(total).cast("decimal(18,0)")  # decimal(37,12), exact at any size
    wanted = F.ceil(exact / F.lit(sample_share)).cast("long")
    cells = (
        targets.select(*labels, "share", "min_rows")
        .join(observed, labels, "left")
        .select(
            *labels,
            F.greatest(wanted, F.coalesce("min_rows", F.lit(0))).alias("target"),
            F.coalesce("available", F.lit(0)).alias("available"),
        )
    )
    margin = F.col("target") * 1.02 + 6 * F.sqrt("target") + 6
    cells = cut_lineage(cells.withColumn("__p", F.least(F.lit(1.0), F.try_divide(margin, F.col("available")))))
    drawn = pool.join(F.broadcast(cells), labels).withColumn("__u", _unit(seed, F.col(key)))
    accepted = drawn.where(F.col("__u") < F.col("__p"))
    short = (
        cells.join(accepted.groupBy(*labels).agg(F.count(F.lit(1)).alias("__n")), labels, "left")
        .where(F.coalesce("__n", F.lit(0)) < F.least("target", "available"))
        .select(*labels)
    )
    short = cut_lineage(short)
    if not short.isEmpty():
        again = cells.join(F.broadcast(short.withColumn("__s", F.lit(True))), labels, "left")
        cells = again.withColumn("__p", F.when(F.col("__s"), 1.0).otherwise(F.col("__p"))).drop("__s")
        drawn = pool.join(F.broadcast(cells), labels).withColumn("__u", _unit(seed, F.col(key)))
        accepted = drawn.where(F.col("__u") < F.col("__p"))
    accepted = cut_lineage(
        accepted.withColumn("__bucket", F.floor(F.col("__u") / F.col("__p") * BUCKETS).cast("int"))
    )
    upto = Window.partitionBy(*labels).orderBy("__bucket")
    counts = accepted.groupBy(*labels, "__bucket", "target").agg(F.count(F.lit(1)).alias("__n"))
    edges = counts.withColumn("__before", F.sum("__n").over(upto) - F.col("__n")).where(
        F.col("__before") < F.col("target")
    )
    # at most BUCKETS rows per cell
    room = edges.select(*labels, "__bucket", (F.col("target") - F.col("__before")).alias("__room"), "__n")
    kept = accepted.join(F.broadcast(room), [*labels, "__bucket"])
    whole = kept.where(F.col("__n") <= F.col("__room"))
    last = Window.partitionBy(*labels, "__bucket").orderBy("__u", key)
    part = (
        kept.where(F.col("__n") > F.col("__room"))
        .withColumn("__r", F.row_number().over(last))
        .where(F.col("__r") <= F.col("__room"))
    )
    sample = cut_lineage(whole.select(key, *labels).union(part.select(key, *labels)))
    got = sample.groupBy(*labels).agg(F.count(F.lit(1)).alias("drawn"))
    report = cells.join(got, labels, "left").select(
        *labels, "target", "available", F.coalesce("drawn", F.lit(0)).alias("drawn")
    )
    return QuotaSample(sample, report.withColumn("deficit", F.col("target") - F.col("drawn")))
