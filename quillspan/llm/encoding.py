"""Problem 6: token ids of a whole corpus."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillspan.llm.bpe import DEFAULT_VOCABULARY, encoder
from quillspan.session import spread


def _shipped(df: DataFrame, vocabulary: str) -> Callable[[], str]:
    """Send a vocabulary of this machine to the workers; gives the path that a worker reads it at."""
    if os.path.exists(vocabulary):
        df.sparkSession.sparkContext.addFile(os.path.realpath(vocabulary))
    sent = os.path.basename(os.path.realpath(vocabulary))

    def path() -> str:
        return vocabulary if os.path.exists(vocabulary) else SparkFiles.get(sent)

    return path


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """`key` and `ids`, the token ids of `text` as an array of integers; one row per input row.

    Null and empty texts have an empty array, any other text the ids of the public
    tokenizer without special tokens (their strings are ordinary text).  Nothing is
    shuffled; texts of any length are encoded whole.
    """
    rows = spread(df.select(key, text))
    out = T.StructType([rows.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    path = _shipped(df, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path())
        for batch in batches:
            flat, offsets = bpe.encode_batch(batch.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return rows.mapInArrow(encode, out)


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """`key` and `tokens`, the number of ids `token_ids` would give."""
    rows = spread(df.select(key, text))
    out = T.StructType([rows.schema[key], T.StructField("tokens", T.LongType(), False)])
    path = _shipped(df, vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path())
        for batch in batches:
            n = bpe.count_batch(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], names=[key, "tokens"])

    return rows.mapInArrow(count, out)
