"""Trajectory shards: `{root}/{source}/data/train-*.parquet`."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.schema import TRAJECTORY, with_columns_of


def read_source(spark: SparkSession, root: str, source: str, pattern: str = "train-*.parquet") -> DataFrame:
    """Rows of one source with `source`, `shard` and `row_in_shard` (0-based within the file).

    Only known columns are read; if a source has none of them, all of its columns are.
    The row index comes from the reader's metadata, so files are split as usual.
    """
    raw = spark.read.option("pathGlobFilter", pattern).parquet(f"{root.rstrip('/')}/{source}/data")
    known = [c for c in TRAJECTORY.fieldNames() if c in raw.columns] or raw.columns
    return raw.select(
        F.lit(source).alias("source"),
        F.concat(F.lit(f"{source}/data/"), F.col("_metadata.file_name")).alias("shard"),
        F.col("_metadata.row_index").alias("row_in_shard"),
        *known,
    )


def read_pool(spark: SparkSession, root: str, sources: tuple[str, ...] = V.SOURCES) -> DataFrame:
    """All sources that exist under `root`, missing columns as null; a missing source is noted and skipped."""
    found = []
    jvm = spark.sparkContext._jvm
    for source in sources:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{source}/data/train-*.parquet")
        matches = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        if not matches:
            print(f"skip {source}: no shards under {root}", file=sys.stderr)
            continue
        found.append(read_source(spark, root, source))
    if not found:
        keys = "source string, shard string, row_in_shard bigint"
        return with_columns_of(spark.createDataFrame([], keys), TRAJECTORY)
    return with_columns_of(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), TRAJECTORY
    )
