"""Problem 2: splits that keep related records together."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspan.operators.ordinals import with_ordinal
from quillspan.session import cut_lineage

EDGES_PER_TASK = 500_000
MOST_SPLITS = 10_000
BROADCAST_STEPS = 100_000


def repo_key(repo: Column) -> Column:
    """`owner/project` in lower case of a repository however written; null if both are not named.

    Read are `owner__project`, `owner/project`, web addresses of any scheme and host
    (whatever follows the project is ignored) and `user@host:owner/project`, with or
    without `.git`, surrounding blanks and slashes.  Nothing is cut off a project name.
    """
    bare = F.regexp_replace(F.lower(repo), r"(?U)^[\s\x00-\x1f​﻿]+|[\s\x00-\x1f​﻿]+$", "")
    address = r"^(?:[a-z][a-z0-9+.-]*://(?:[^/@]*@)?[^/]+/+|(?:[^/@\s]+@)[^/:\s]+:/*)"
    path = F.regexp_replace(bare, address, "")
    path = F.regexp_replace(path, r"[?#].*$", "")
    pattern = r"^/*([^/]+?)(?:__|/+)([^/]+?)(?:\.git)?(?:/.*)?$"
    owner, project = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    return F.when((owner != "") & (project != ""), F.concat(owner, F.lit("/"), project))


def instance_key(instance_id: Column) -> Column:
    """The id without case and surrounding blanks; null if nothing is left."""
    bare = F.regexp_replace(F.lower(instance_id), r"(?U)^[\s\x00-\x1f]+|[\s\x00-\x1f]+$", "")
    return F.nullif(bare, F.lit(""))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the (a, b) rows of one partition: (node, least node of its tree)."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([find(x) for x in part], pa.string())], names=["node", "root"]
        )


def components(links: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) of every node of the links (a, b), strings without nulls; root names the component.

    Each partition builds a forest over its own links.  A node that grew in several
    partitions ties their trees together; those ties, links between roots only, are the
    links of the next level, on as many partitions as their number needs.  Levels shrink
    until no ties are left and their forests are then applied on the way back.  A node
    with any number of links is one row per partition after the first step, so hot nodes
    need no special care; a repeated task gives the same forest.
    """
    forests: list[DataFrame] = []
    level = links
    while True:
        forest = cut_lineage(level.mapInArrow(_forest, "node string, root string"))
        least = F.min("root").over(Window.partitionBy("node"))
        tied = forest.withColumn("least", least)
        ties = tied.where("root <> least").select(F.col("root").alias("a"), F.col("least").alias("b")).distinct()
        ties = cut_lineage(ties)
        forests.append(forest.groupBy("node").agg(F.min("root").alias("root")))
        n = ties.count()
        if not n:
            break
        level = ties.repartition(max(1, -(-n // edges_per_task)), "b")
    mapping = forests.pop()
    while forests:
        above = mapping.select(F.col("node").alias("root"), F.col("root").alias("top"))
        mapping = (
            forests.pop()
            .join(above, "root", "left")
            .select("node", F.coalesce("top", "root").alias("root"))
        )
    return cut_lineage(mapping)


def linked(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Links (a, b) between the non-null `keys` of each row, the values tagged with their key's name.

    A row with one key is a link of that key to itself, a row with none gives nothing.
    """
    tagged = [F.concat(F.lit(f"{name}="), column) for name, column in keys.items()]
    present = df.select(F.array_compact(F.array(*tagged)).alias("k")).where(F.size("k") > 0)
    pairs = F.transform(F.col("k"), lambda x: F.struct(F.get("k", F.lit(0)).alias("a"), x.alias("b")))
    return present.select(F.inline(pairs))


def balance(sizes: list[tuple[int, int]], shares: list[tuple[str, float]]) -> dict[int, list[tuple[str, int]]]:
    """Greedy largest-first in bulk: {size: [(split, groups of that size), ...]}.

    Groups go one by one, largest first, to the split furthest below its target (ties:
    first in `shares`).  Groups of one size are interchangeable, so each size is placed
    at once: of the values deficit - i * size over all splits and i >= 0, the greatest as
    many as there are groups are exactly those placements.
    """
    total = sum(size * n for size, n in sizes)
    whole = sum(share for _, share in shares)
    deficit = {name: total * share / whole for name, share in shares}
    plan: dict[int, list[tuple[str, int]]] = {}
    for size, n in sorted(sizes, reverse=True):
        low, high = min(deficit.values()) - size * (n + 1), max(deficit.values()) + size
        for _ in range(200):
            middle = (low + high) / 2
            if sum(max(0, int((d - middle) // size) + 1) for d in deficit.values() if d >= middle) > n:
                low = middle
            else:
                high = middle
        take = {k: max(0, int((d - high) // size) + 1) if d >= high else 0 for k, d in deficit.items()}
        left = n - sum(take.values())
        while left > 0:
            k = max(deficit, key=lambda s: deficit[s] - take[s] * size)
            take[k] += 1
            left -= 1
        for k, m in take.items():
            deficit[k] -= m * size
        plan[size] = [(k, m) for k, m in take.items() if m]
    return plan


def assign_groups(members: DataFrame, group: str, targets: DataFrame) -> DataFrame:
    """(group, split): every group whole in one split, sizes near the shares of `targets` (split, share).

    `members` has one row per record.  The driver sees one row per distinct group size
    (fewer than the square root of twice the records) and the splits (at most 10,000,
    checked); which group of a size goes where follows from its position among them,
    computed without collecting groups.  Equal input gives an equal assignment.
    """
    shares = [(r.split, float(r.share or 0)) for r in targets.limit(MOST_SPLITS + 1).collect()]
    if len(shares) > MOST_SPLITS or not sum(share for _, share in shares) > 0:
        raise ValueError(f"need between 1 and {MOST_SPLITS} splits whose shares sum to more than 0")
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    ranked = cut_lineage(with_ordinal(sizes, ["size", group], "rank", within=["size"]))
    histogram = [(r.size_, r.n) for r in ranked.groupBy(F.col("size").alias("size_")).agg(F.count(F.lit(1)).alias("n")).collect()]
    plan = []
    for size, parts in balance(histogram, shares).items():
        at = 0
        for split, n in parts:
            plan.append((size, at, at + n, split))
            at += n
    spark = members.sparkSession
    steps = spark.createDataFrame(plan, "size bigint, first bigint, beyond bigint, split string")
    hit = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    if len(plan) <= BROADCAST_STEPS:  # else the planner's choice, with its care for skewed sizes
        steps = F.broadcast(steps)
    return ranked.join(steps, "size").where(hit).select(group, "split")


def grouped_split(df: DataFrame, key: str, keys: dict[str, Column], targets: DataFrame) -> DataFrame:
    """(key, split) of each distinct non-null `key`, records linked through `keys` in one split.

    Rows of one `key` stay together whatever else they say.  Rows without one are in no
    split, but what they link stays together, as in `must_share`.
    """
    records = df.where(F.col(key).isNotNull())
    own = F.concat(F.lit("="), F.col(key))
    roots = components(linked(df, {"": F.col(key), **keys}))
    members = records.select(own.alias("node"), F.col(key)).distinct().join(roots, "node").select(key, "root")
    members = cut_lineage(members)
    splits = assign_groups(members, "root", targets)
    return members.join(splits, "root").select(key, "split")


def must_share(df: DataFrame, value: str, keys: dict[str, Column]) -> DataFrame:
    """(value, root) of each distinct non-null `value`: equal roots must share a split.

    A value is linked by all `keys` of the rows it occurs in.
    """
    rows = df.where(F.col(value).isNotNull())
    roots = components(linked(df, keys | {"value": F.col(value)}))
    own = rows.select(F.col(value)).distinct().withColumn("node", F.concat(F.lit("value="), F.col(value)))
    return own.join(roots, "node").select(value, "root")


def pairs_of(members: DataFrame, value: str, group: str) -> DataFrame:
    """All pairs (value_a, value_b) of one group, the smaller by code points first.

    The number of rows is quadratic in a group's distinct values by definition.
    """
    a = members.select(group, F.col(value).alias(f"{value}_a"))
    b = members.select(group, F.col(value).alias(f"{value}_b"))
    both = a.join(b, group).where(F.col(f"{value}_a") < F.col(f"{value}_b"))
    return both.select(f"{value}_a", f"{value}_b")
