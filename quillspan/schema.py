"""Spark types of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
TURNS = T.ArrayType(TURN)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


TRAJECTORY = _table(
    ("instance_id", T.StringType()),
    ("messages", TURNS),
    ("repo", T.StringType()),
    ("language", T.StringType()),
    ("family", T.StringType()),
    ("first_edit", T.IntegerType()),
)
PREFIX = _table(
    ("sample_id", T.StringType()),
    ("phase_wanted", T.StringType()),
    ("phase_labeled", T.StringType()),
    ("turn_idx", T.IntegerType()),
    ("horizon", T.IntegerType()),
    ("source", T.StringType()),
    ("instance_id", T.StringType()),
    ("repo", T.StringType()),
    ("language", T.StringType()),
    ("family", T.StringType()),
    ("first_edit", T.IntegerType()),
    ("asst_in_row", T.IntegerType()),
    ("asst_in_prefix", T.IntegerType()),
    ("prefix_chars", T.IntegerType()),
    ("messages", TURNS),
)
ROLLOUT = _table(
    ("sample_id", T.StringType()),
    ("rollout", T.IntegerType()),
    ("n_rollouts", T.IntegerType()),
    ("phase_wanted", T.StringType()),
    ("source", T.StringType()),
    ("instance_id", T.StringType()),
    ("horizon", T.IntegerType()),
    ("stopped", T.StringType()),
    ("commands", T.ArrayType(T.StringType())),
    ("messages", TURNS),
    ("continuation", TURNS),
    ("backend", T.StringType()),
)
JUDGED = T.StructType(
    ROLLOUT.fields
    + _table(
        ("keep", T.BooleanType()), ("drop", T.BooleanType()), ("reasons", T.ArrayType(T.StringType()))
    ).fields
)
SFT = _table(
    ("kind", T.StringType()),
    ("sample_id", T.StringType()),
    ("phase_wanted", T.StringType()),
    ("n_prefix", T.IntegerType()),
    ("messages", TURNS),
)
DPO = _table(
    ("kind", T.StringType()),
    ("sample_id", T.StringType()),
    ("phase_wanted", T.StringType()),
    ("prompt", TURNS),
    ("chosen", TURNS),
    ("rejected", TURNS),
    ("chosen_rollout", T.IntegerType()),
    ("rejected_rollout", T.IntegerType()),
    ("rejected_reasons", T.ArrayType(T.StringType())),
)
TOKENS = _table(
    ("input_ids", T.ArrayType(T.IntegerType())),
    ("attention_mask", T.ArrayType(T.IntegerType())),
    ("labels", T.ArrayType(T.IntegerType())),
)


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of `schema` that `df` lacks as typed nulls; other columns stay."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def truthy(value: Column | str) -> Column:
    """Null for null and for the empty string, else the value."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(""))


def normalized_turns(df: DataFrame, name: str = "messages") -> Column:
    """`ARRAY<STRUCT<role,content>>` of a turn column whose structs may call the fields speaker and text.

    role falls back to speaker and content to text when null or empty, then to the
    empty string.  A null array stays null, a null turn becomes a turn of empty role.
    """
    fields = {f.name for f in df.schema[name].dataType.elementType.fields}

    def pick(turn: Column, *names: str) -> Column:
        found = [truthy(turn[n].cast("string")) for n in names if n in fields]
        return F.coalesce(*found, F.lit(""))

    return F.transform(
        F.col(name),
        lambda t: F.struct(
            pick(t, "role", "speaker").alias("role"), pick(t, "content", "text").alias("content")
        ),
    )
