"""One row per key from tables into which rows were loaded more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], loaded: str = "loaded_at") -> DataFrame:
    """The row of each key that was loaded last; a null time counts as earliest, a null key is a key.

    Project the columns you need first: the rows move to their keys.  The planner keeps one
    row per key and partition before that.  Rows equal in key and time: one of them.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(loaded).desc_nulls_last())
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")
