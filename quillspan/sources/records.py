"""JSON Lines and Parquet records between the steps, and the small JSON reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan import fixed_values as V


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Records of one or more JSON Lines files or folders; blank lines are skipped.

    Lines end at a line feed only: a record holding U+0085, U+2028 or U+2029 stays whole.
    """
    return spark.read.schema(schema).option("lineSep", "\n").json(paths)


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object a line, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_split(judged: DataFrame, path: str, mode: str = "error") -> None:
    """Kept and dropped rollouts as JSON Lines under `keep=true` and `keep=false`, in one pass."""
    rows = judged.withColumn("__keep", F.col("keep"))
    rows = rows.withColumnRenamed("keep", "kept").withColumnRenamed("__keep", "keep")
    rows.write.mode(mode).partitionBy("keep").option("ignoreNullFields", "false").json(path)


def read_split(spark: SparkSession, path: str, schema: T.StructType, keep: bool | None = None) -> DataFrame:
    """Rollouts written by `write_split`, both sides or one (only its folder is read)."""
    stored = T.StructType(
        [f if f.name != "keep" else T.StructField("kept", T.BooleanType()) for f in schema.fields]
    )
    rows = spark.read.schema(stored.add("keep", T.BooleanType())).option("lineSep", "\n").json(path)
    if keep is not None:
        rows = rows.where(F.col("keep") == F.lit(keep))
    return rows.select(*schema.fieldNames())


def write_report(report: dict, path: str, spark: SparkSession | None = None) -> None:
    """A small report or recipe as indented JSON, in one file.

    With a session, on whatever file system the path names; without one, on this machine's.
    """
    text = json.dumps(report, indent=2, ensure_ascii=False) + "\n"
    if spark is None:
        target = Path(path)
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text, encoding="utf-8")
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def recipe(base: str, sft: str, dpo: str, out_dir: str) -> dict:
    """What a training run would read and how; nothing is trained here."""
    return {
        "base": base,
        "order": ["sft", "dpo"],
        "sft": {"data": sft} | V.SFT_RECIPE,
        "dpo": {"data": dpo} | V.DPO_RECIPE,
        "do_not": list(V.DO_NOT),
        "out_dir": out_dir,
        "adapter_dir": f"{out_dir.rstrip('/')}/adapter",
    }
