"""Problem 4: runs of one event in ordered sequences."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.llm.commands import cached_digest
from quillspan.session import cut_lineage, spread

FAN_IN = 256
_EDGES = "__block", "__place"


def _encoder(n_seq: int, schema: pa.Schema, blocks: bool):
    """Joins what is adjacent in sorted rows; the first and last run of each block are marked by `__block`.

    Rows of events are (sequence columns, pos, form, ms, carried), all of a partition being
    one block; those of runs (`blocks`) are laid out as `schema`.  Of repeated positions the
    first counts.  Only the open run is held.
    """

    def read(batch: pa.RecordBatch, part: int) -> Iterator[tuple]:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        if blocks:
            for row in rows:
                yield row[-2], row[:n_seq], row[n_seq], *row[n_seq + 1 : n_seq + 5], row[n_seq + 5 : -2]
        else:
            for row in rows:
                pos, form, ms = row[n_seq : n_seq + 3]
                yield part, row[:n_seq], form, pos, pos, 1, ms, row[n_seq + 3 :]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        done: list[tuple] = []
        run: list | None = None
        place = 0

        def close(last: bool) -> None:
            block, seq, form, first, end, n, ms, more = run
            done.append((*seq, form, first, end, n, ms, *more, block if last or place == 0 else None, place))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(schema)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
            done.clear()
            return batch

        for batch in batches:
            for row in read(batch, part):
                block, seq, form, first, end, n, ms, _more = row
                if run is not None and run[0] == block:
                    if run[1] == seq:
                        if end <= run[4]:
                            continue
                        if run[2] == form and first == run[4] + 1:
                            run[4], run[5] = end, run[5] + n
                            if ms is not None:
                                run[6] = ms + (run[6] or 0)
                            continue
                    close(last=False)
                    place += 1
                elif run is not None:
                    close(last=True)
                    place = 0
                run = list(row)
            if len(done) >= 10_000:
                yield emit()
        if run is not None:
            close(last=True)
        yield emit()

    return encode


def collapse_runs(
    events: DataFrame, sequence: list[str], pos: str = "pos", form: str = "form", ms: str = "ms", carry: list[str] = ()
) -> DataFrame:
    """One row per maximal run: sequence columns, form, first_pos, last_pos, n, total_ms and `carry`.

    Neighbours are events of one sequence at positions p and p + 1 with equal forms.  Events
    with a null form or position belong to no run and end one (they are left out, which
    leaves a gap); a position read twice counts once.  `total_ms` sums the known durations,
    null if none is known.  `carry` columns are those of the run's first event.

    Events are range-partitioned by sequence and position, so a sequence of any length is
    spread; each partition encodes its runs alone.  Only the first and last run of a
    partition can go on elsewhere: those are joined, which is associative, over blocks of
    `FAN_IN` neighbouring partitions at once, then over blocks of such blocks, until one is
    left.  No task of the merge sees more than two runs of each of its `FAN_IN` parts.
    `events` are read twice (range bounds are sampled): pass rows that are cheap to read.
    """
    ordered = [*sequence, pos]
    rows = events.where(F.col(form).isNotNull() & F.col(pos).isNotNull())
    rows = rows.select(*sequence, F.col(pos).cast("long").alias(pos), form, F.col(ms).cast("long").alias(ms), *carry)
    placed = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    names = [*sequence, form, "first_pos", "last_pos", "n", "total_ms", *carry]
    out = T.StructType(
        [rows.schema[c] for c in sequence]
        + [rows.schema[form]]
        + [T.StructField(c, T.LongType()) for c in ("first_pos", "last_pos", "n", "total_ms")]
        + [rows.schema[c] for c in carry]
        + [T.StructField(c, T.LongType()) for c in _EDGES]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, (block, place) = to_arrow_schema(out), _EDGES
    level = cut_lineage(placed.mapInArrow(_encoder(len(sequence), schema, False), out))
    closed = level.where(F.col(block).isNull()).select(*names)
    while True:
        edges = level.where(F.col(block).isNotNull())
        beyond = edges.agg((F.max(block) + 1).alias("n")).first().n or 0
        if beyond <= 1:
            return closed.union(edges.select(*names))
        # the place within the next level's block: that of the part, then first before last
        parts = edges.withColumn(place, F.col(block)).withColumn(block, F.floor(F.col(block) / FAN_IN).cast("long"))
        parts = parts.repartition(-(-beyond // FAN_IN), block).sortWithinPartitions(block, place, *sequence, "first_pos")
        level = cut_lineage(parts.mapInArrow(_encoder(len(sequence), schema, True), out))
        closed = closed.union(level.where(F.col(block).isNull()).select(*names))


def command_events(
    df: DataFrame, keys: list[str], commands: str = "commands", ms: str | None = "cmd_ms", text: bool = False
) -> DataFrame:
    """(keys, version, pos, form, ms and, on request, command) of every entry of a command list.

    Positions count from 0.  `form` is a 128-bit digest of the command's canonical form, null
    for null and blank entries.  `ms` is the duration at the same position, null where the
    list is null or shorter.  `version` tells lists apart that are stored under one key with
    different contents; equal rows loaded twice give equal events.
    """
    durations = F.col(ms) if ms else F.lit(None).cast("array<bigint>")
    aligned = F.transform(commands, lambda _c, i: F.get(durations, i).cast("long"))
    version = F.xxhash64(F.col(commands), durations).alias("version")
    rows = spread(df.select(*keys, version, F.col(commands).alias("__c"), aligned.alias("__m")))
    out = T.StructType(
        [rows.schema[k] for k in keys]
        + [
            T.StructField("version", T.LongType()),
            T.StructField("pos", T.LongType()),
            T.StructField("form", T.BinaryType()),
            T.StructField("ms", T.LongType()),
        ]
        + ([T.StructField("command", T.StringType())] if text else [])
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, lists, times = batch.columns
            lists, times = (x.take(pc.indices_nonzero(lists.is_valid())) for x in (lists, times))
            own = [c.take(pc.indices_nonzero(batch.column(len(own)).is_valid())) for c in own]
            parents = lists.value_parent_indices() if len(lists) else pa.array([], pa.int64())
            said = lists.flatten()
            starts = pa.array(lists.offsets.to_numpy()[:-1] - (lists.offsets[0].as_py() if len(lists) else 0))
            position = pc.subtract(pa.array(range(len(said)), pa.int64()), starts.take(parents).cast(pa.int64()))
            raw = said.to_pylist()
            forms = pa.array([cached_digest(c) for c in raw], pa.binary())
            columns = [c.take(parents) for c in own] + [position, forms, times.flatten()]
            if text:
                columns.append(said)
            columns = [c.cast(f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(explode, out)


def repeated(runs: DataFrame) -> Column:
    """Whether a row of `collapse_runs` is a run of two or more."""
    return runs["n"] >= 2
