"""From raw trajectories to prefix records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import ids, turns
from quillspan.schema import TRAJECTORY, normalized_turns, truthy, with_columns_of


def leaked_instances(df: DataFrame) -> DataFrame:
    """The fixed list of (source, instance_id) that must not be used, as a table of 13 rows."""
    return df.sparkSession.createDataFrame(list(V.LEAKED_INSTANCES), "source string, instance_id string")


def without_leaks(df: DataFrame, leaks: DataFrame | None = None) -> DataFrame:
    """Rows whose (source, instance_id) is not in `leaks`; rows with a null in either are kept.

    The fixed list is broadcast (13 rows); a list of the caller's own is left to the planner.
    """
    banned = F.broadcast(leaked_instances(df)) if leaks is None else leaks
    return df.join(banned.select("source", "instance_id").distinct(), ["source", "instance_id"], "left_anti")


def trajectory_entries(df: DataFrame, leaks: DataFrame | None = None) -> DataFrame:
    """One entry per usable trajectory row.

    Needs source, shard, row_in_shard and instance_id; other trajectory columns may be
    missing and count as null, further columns are dropped.  Rows with a null or empty
    instance_id and leaked rows are left out; null messages become an empty list.  A
    given first_edit wins over the detected one, 0 included.
    """
    df = with_columns_of(df, TRAJECTORY)
    kept = without_leaks(df.where(truthy("instance_id").isNotNull()), leaks)
    iid, source = F.col("instance_id"), F.col("source")
    messages = turns.or_empty(normalized_turns(kept))
    base = kept.select(
        "source",
        "shard",
        F.col("row_in_shard").alias("row"),
        "instance_id",
        ids.repo_of(F.col("repo"), iid).alias("repo"),
        ids.language_of(F.col("language"), source).alias("language"),
        F.coalesce(truthy("family"), ids.family_of(iid, source)).alias("family"),
        F.col("first_edit").alias("given_edit"),
        messages.alias("messages"),
    )
    return base.select(
        *[c for c in base.columns if c not in ("given_edit", "messages")],
        turns.assistant_count(F.col("messages")).alias("asst"),
        F.coalesce(F.col("given_edit"), turns.first_edit_index(F.col("messages"))).alias("first_edit"),
        "messages",
    )


def source_rank(source: Column | str = "source") -> Column:
    """Position of a source in the fixed list; unknown sources come after it."""
    column = F.col(source) if isinstance(source, str) else source
    at = F.array_position(F.array(*[F.lit(s) for s in V.SOURCES]), column)
    return F.when(at > 0, at - 1).otherwise(len(V.SOURCES)).cast("int")


def pool_head(entries: DataFrame, max_rows: int) -> DataFrame:
    """The first `max_rows` entries in the order of sources, shards and rows.

    The top-k is over keys; of the entries themselves those up to the last key are filtered
    where they stand, and rows repeated under that key only as far as they count.
    """
    key = F.struct(source_rank().alias("rank"), "source", "shard", "row", "instance_id")
    top = entries.select(key.alias("k")).orderBy("k").limit(max_rows)
    last = top.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("k")).first()
    if last is None:
        return entries.limit(0)
    edge = entries.sparkSession.createDataFrame([(last.k,)], top.schema)
    placed = entries.join(F.broadcast(edge), key <= F.col("k"))
    before = placed.where(key < F.col("k")).select(*entries.columns)
    return before.union(placed.where(key == F.col("k")).select(*entries.columns).limit(last.n))


def phase_turn(phase: str, first_edit: str = "first_edit", instance_id: str = "instance_id") -> Column:
    return ids.turn_index_for(phase, F.col(first_edit), ids.cold_pick(F.col(instance_id)))


def cut(entries: DataFrame, phase: str) -> DataFrame:
    """Entries that can be cut for `phase`, with `turn_idx` and the cut `prefix`; messages are dropped."""
    cutd = entries.withColumn("turn_idx", phase_turn(phase))
    cutd = cutd.withColumn("prefix", turns.cut_before(F.col("messages"), F.col("turn_idx"))).drop("messages")
    return cutd.where(turns.can_cut(F.col("asst"), phase, F.col("turn_idx"), F.col("prefix")))


def prefix_records(cutd: DataFrame, phase: Column | str, horizon: Column, *more: str) -> DataFrame:
    """The 15-column prefix records of cut entries, and `more` of their columns."""
    wanted = F.lit(phase) if isinstance(phase, str) else phase
    prefix = F.col("prefix")
    return cutd.select(
        ids.sample_id(F.col("shard"), F.col("row"), F.col("turn_idx")).alias("sample_id"),
        wanted.alias("phase_wanted"),
        turns.phase_of(prefix).alias("phase_labeled"),
        "turn_idx",
        horizon.cast("int").alias("horizon"),
        "source",
        "instance_id",
        "repo",
        "language",
        "family",
        "first_edit",
        F.col("asst").alias("asst_in_row"),
        turns.assistant_count(prefix).alias("asst_in_prefix"),
        turns.char_count(prefix).cast("int").alias("prefix_chars"),
        prefix.alias("messages"),
        *more,
    )
