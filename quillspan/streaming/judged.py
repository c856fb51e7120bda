"""Judging rollouts as files arrive.

The rules look at one row at a time, so the batch operator is used as it is; no state or
watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillspan.operators.judge import judge
from quillspan.schema import ROLLOUT


def judged_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Judged rows of the Parquet files that appear under `path`."""
    raw = spark.readStream.schema(ROLLOUT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return judge(raw)


def write_judged(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now as Parquet split by keep, then stop; exactly once across restarts."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("drop")
        .trigger(availableNow=True)
        .start()
    )
