"""Problem 7: items into containers of fixed capacity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.session import cut_lineage

OPEN_BINS = 64
GROUP_ROWS = 50_000
MOST_SPECS = 1000


@dataclass
class BestFit:
    """Bounded-space online best fit.

    At most `open_bins` containers are open.  An item goes into the fullest open one that
    holds it, found in a bitset over free space; without one a new container is opened,
    and if that would be one too many the fullest closes first.  A container also closes
    when it is full, however many items it holds.  Closed containers come out as
    (number, free space, items).
    """

    capacity: int
    open_bins: int = OPEN_BINS
    bits: int = 0
    by_free: dict[int, list[int]] = field(default_factory=dict)
    items: dict[int, list] = field(default_factory=dict)
    numbers: int = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        return number

    def _keep(self, number: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(number)
        self.bits |= 1 << free

    def _fullest(self, at_least: int) -> int:
        """Least free space >= at_least among the open containers, -1 if there is none."""
        above = self.bits >> at_least
        return at_least + (above & -above).bit_length() - 1 if above else -1

    def put(self, size: int, item: object) -> Iterator[tuple[int, int, list]]:
        free = self._fullest(size)
        if free >= 0:
            number = self._take(free)
        else:
            if len(self.items) >= self.open_bins:
                least = self._fullest(0)
                closed = self._take(least)
                yield closed, least, self.items.pop(closed)
            number, free = self.numbers, self.capacity
            self.numbers += 1
            self.items[number] = []
        self.items[number].append(item)
        free -= size
        if free == 0:
            yield number, free, self.items.pop(number)
        else:
            self._keep(number, free)

    def close(self) -> Iterator[tuple[int, int, list]]:
        while (free := self._fullest(0)) >= 0:
            number = self._take(free)
            yield number, free, self.items.pop(number)


def pieces_of(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, size) of the pieces of an item: itself, or full containers and a rest if it exceeds one."""
    if size <= capacity:
        return [(0, size)]
    return [(at, min(capacity, size - at)) for at in range(0, size, capacity)]


def pack(
    sizes: DataFrame,
    specs: DataFrame,
    key: str,
    size: str = "tokens",
    open_bins: int = OPEN_BINS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Rows (spec, key, piece, start, size, container, free): each item or piece and its container.

    `sizes` has one row per item; `specs` the columns spec and capacity (at most 1000 rows,
    checked).  An item is divided only if it alone exceeds the capacity, into full pieces
    and a rest.  Items of size 0 take no space and go into the fullest open container; a
    null size counts as 0.  A container is named `spec:group:number`; `free` is the space
    left in it.

    Items are spread by a hash of the key into ceil(items / group_rows) groups, which are
    packed independently in the order of the key, so the result depends neither on the
    partitioning nor on a task being repeated.  Only (key, size) rows are shuffled.
    """
    bounds = specs.select("spec", "capacity").limit(MOST_SPECS + 1).collect()
    if len(bounds) > MOST_SPECS or any(b.capacity is None or b.capacity < 1 for b in bounds):
        raise ValueError(f"need at most {MOST_SPECS} specs, each of capacity 1 or more")
    capacity = {b.spec: int(b.capacity) for b in bounds}
    sizes = cut_lineage(
        sizes.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("long").alias(size)).distinct()
    )
    groups = max(1, -(-sizes.count() // group_rows))
    tasks = sizes.withColumn("group", F.pmod(F.xxhash64(F.lit("pack"), key), F.lit(groups)).cast("int"))
    spec_names = F.array(*[F.lit(s) for s in capacity]).cast("array<string>")
    tasks = tasks.withColumn("spec", F.explode(spec_names)).select("spec", "group", key, size)
    many = max(1, min(groups * max(1, len(capacity)), 10_000))
    ordered = tasks.repartition(many, "spec", "group").sortWithinPartitions("spec", "group", key, size)
    out = T.StructType(
        [
            T.StructField("spec", T.StringType()),
            sizes.schema[key],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField(size, T.LongType()),
            T.StructField("container", T.StringType()),
            T.StructField("free", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        bins = BestFit(1)
        rows: list[tuple] = []

        def note(closed: Iterator[tuple[int, int, list]]) -> None:
            for number, free, items in closed:
                name = f"{at[0]}:{at[1]}:{number}"
                rows.extend((at[0], *item, name, free) for item in items)

        def emit() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
            rows.clear()
            return batch

        for batch in batches:
            for spec, group, name, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (spec, group) != at:
                    if at is not None:
                        note(bins.close())
                    at, bins = (spec, group), BestFit(capacity[spec], open_bins)
                for piece, (start, part) in enumerate(pieces_of(n, capacity[spec])):
                    note(bins.put(part, (name, piece, start, part)))
            if len(rows) >= 10_000:
                yield emit()
        if at is not None:
            note(bins.close())
        yield emit()

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    return ordered.mapInArrow(run, out)


def pack_summary(packed: DataFrame, size: str = "tokens") -> DataFrame:
    """(spec, containers, filled, unused) of `pack`'s rows."""
    each = packed.groupBy("spec", "container").agg(F.sum(size).alias("filled"), F.max("free").alias("free"))
    return each.groupBy("spec").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("filled").alias("filled"), F.sum("free").alias("unused")
    )
