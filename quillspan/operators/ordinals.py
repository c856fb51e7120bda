"""Global row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspan.session import cut_lineage

_INDEX_BITS = 33


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", within: list[str] | None = None) -> DataFrame:
    """Add `name`: the 0-based position of each row in the order of the columns `order` (nulls first).

    `within` columns must be a prefix of `order`; positions then restart for each of their
    values.  Rows are range-partitioned and sorted, so no partition holds a whole group;
    only one count per partition (and value of `within`) is joined back.  Rows equal in
    all `order` columns get consecutive positions in no particular order: pass a unique
    column last where ties matter.  An empty table gives an empty table.
    """
    within = within or []
    if order[: len(within)] != within:
        raise ValueError("`within` must be a prefix of `order`")
    spot, part = f"__{name}_at", f"__{name}_part"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn(spot, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(spot, _INDEX_BITS))
    key = [part, *within]
    first, before = f"__{name}_first", f"__{name}_before"
    counts = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.min(spot).alias(first))
    # few rows: one per partition and value of `within` that occurs in it
    w = Window.partitionBy(*(within or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"__k_{c}") for c in key],
        F.col(first),
        F.coalesce(F.sum("__n").over(w), F.lit(0)).alias(before),
    )
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in key]
    joined = placed.join(offsets, on)
    position = F.col(spot) - F.col(first) + F.col(before)
    return joined.withColumn(name, position.cast("long")).select(*df.columns, name)
