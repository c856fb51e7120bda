"""Loss masks, truncation, padding and the row filters before training."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions.text import strip_blank
from quillspan.functions.turns import content_of, or_empty
from quillspan.operators.ordinals import with_ordinal
from quillspan.schema import TOKENS

#: gives (ids, [(start, end) in characters]) of a text
Tokenize = Callable[[str], tuple[list[int], list[tuple[int, int]]]]

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _role(turn: Column) -> Column:
    return F.coalesce(turn["role"], F.lit(""))


def has_user_query(messages: Column) -> Column:
    """Some user turn whose stripped content is not wholly one tool-response envelope."""

    def asks(turn: Column) -> Column:
        said = strip_blank(content_of(turn))
        wrapped = F.startswith(said, F.lit("<tool_response>")) & F.endswith(said, F.lit("</tool_response>"))
        return (_role(turn) == "user") & ~wrapped

    return F.exists(or_empty(messages), asks)


def _is_block(turn: Column, i: Column) -> Column:
    return ((_role(turn) == "system") & (i == 0)) | _role(turn).isin("user", "assistant")


def rendered_blocks_before(messages: Column, n_prefix: Column) -> Column:
    """Blocks the template renders for the first `n_prefix` turns: system only at 0, user, assistant."""
    head = F.slice(or_empty(messages), F.lit(1), F.greatest(n_prefix, F.lit(0)))
    return F.size(F.filter(head, _is_block))


def render(messages: Column) -> Column:
    """The turns a template renders, as `<|im_start|>role newline content<|im_end|> newline` blocks."""
    blocks = F.filter(or_empty(messages), _is_block)
    return F.array_join(
        F.transform(
            blocks, lambda t: F.concat(F.lit(OPEN), _role(t), F.lit("\n"), content_of(t), F.lit(CLOSE + "\n"))
        ),
        "",
    )


def loss_plan(messages: Column, n_prefix: Column) -> Column:
    """`STRUCT<cut, spans>`: where loss may begin in the rendered text, and the spans that carry it.

    `cut` is the 0-based character at which the first block after the prefix starts (the
    text's length if there is none).  A span is a whole assistant block at or after it,
    header included.  Contents that hold the opening marker stay one block.
    """
    blocks = F.filter(or_empty(messages), _is_block)
    sized = F.transform(
        blocks,
        lambda t: F.struct(
            (F.length(_role(t)) + F.length(content_of(t)) + len(OPEN) + len(CLOSE) + 2).alias("n"),
            (_role(t) == "assistant").alias("own"),
        ),
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).alias("i"),
        F.lit(0).alias("cut"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
    )
    before = rendered_blocks_before(messages, n_prefix)

    def step(acc: Column, b: Column) -> Column:
        end = acc["at"] + b["n"]
        late = acc["i"] >= before
        span = F.struct(acc["at"].alias("start"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            (acc["i"] + 1).alias("i"),
            F.when(late, acc["cut"]).otherwise(end).alias("cut"),
            F.when(b["own"] & late, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(
        sized, start, step, lambda acc: F.struct(acc["cut"].alias("cut"), acc["spans"].alias("spans"))
    )


def blank_tokenizer(text: str) -> tuple[list[int], list[tuple[int, int]]]:
    """Tokens are runs of non-blank characters; ids are checksums.  For tests and size estimates."""
    import re
    import zlib

    spans = [m.span() for m in re.finditer(r"\S+", text)]
    return [zlib.crc32(text[a:b].encode()) % 50_000 for a, b in spans], spans


@lru_cache(maxsize=2)
def _tokenizer_of(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def file_tokenizer(path: str) -> Tokenize:
    """The tokenizer of a `tokenizer.json` that every worker can read, loaded once in each; nothing is added to a text."""

    def tokenize(text: str) -> tuple[list[int], list[tuple[int, int]]]:
        coded = _tokenizer_of(path).encode(text, add_special_tokens=False)
        return coded.ids, coded.offsets

    return tokenize


def sft_examples(
    sft: DataFrame,
    tokenize: Tokenize = blank_tokenizer,
    max_len: int = 8192,
    drop_fully_masked: bool = False,
    keep: tuple[str, ...] = ("sample_id",),
) -> DataFrame:
    """input_ids, attention_mask and labels of supervised rows, with the `keep` columns.

    A token carries its id as label if it starts at or after the prefix and overlaps an
    assistant block, else -100.  Rows without a user query, with fewer than two tokens or
    with nothing to learn are left out.  Truncation to `max_len` comes after that, so a
    long prefix can leave only -100; `drop_fully_masked` leaves those out too.  Rendering
    and spans are JVM-side; Python sees the text, the spans and the kept columns.
    """
    messages, n_prefix = F.col("messages"), F.col("n_prefix")
    ready = sft.where(has_user_query(messages)).select(
        *keep, render(messages).alias("__text"), loss_plan(messages, n_prefix).alias("__plan")
    )
    out = sft.select(*keep).schema
    for field in TOKENS.fields:
        out = out.add(field)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text, plan = row.pop("__text"), row.pop("__plan")
                cut, spans = plan["cut"], plan["spans"]
                ids, offsets = tokenize(text)
                if len(ids) < 2 or not spans:
                    continue
                ids = np.asarray(ids, dtype=np.int32)
                start, end = np.asarray(offsets, dtype=np.int64).reshape(-1, 2).T
                first, last = (np.array([s[k] for s in spans]) for k in ("start", "end"))
                at = np.minimum(np.searchsorted(last, start, side="right"), len(spans) - 1)  # first span that ends after the token starts
                learned = (start >= cut) & (end > start) & (last[at] > start) & (end > first[at])
                if not learned.any() or (drop_fully_masked and not learned[:max_len].any()):
                    continue
                labels = np.where(learned, ids, V.IGNORE_LABEL)[:max_len]
                rows.append(row | {"input_ids": ids[:max_len], "attention_mask": np.ones(len(labels), np.int32), "labels": labels})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)
    return ready.mapInArrow(encode, out)


def skip_counts(sft: DataFrame, examples: DataFrame) -> DataFrame:
    """One row: n_rows, n_examples, n_skipped."""
    a = sft.agg(F.count(F.lit(1)).alias("n_rows"))
    b = examples.agg(F.count(F.lit(1)).alias("n_examples"))
    return a.join(F.broadcast(b)).withColumn("n_skipped", F.col("n_rows") - F.col("n_examples"))


def batched(examples: DataFrame, order: list[str], rows: int, name: str = "batch") -> DataFrame:
    """Add `name`: the number of the batch of `rows` examples that a row falls into in `order`; the last may be short.

    Positions come from range partitions.  `order` must identify rows for batches to be the
    same again.  An empty table stays empty.
    """
    placed = with_ordinal(examples, order, "__at")
    return placed.withColumn(name, F.floor(F.col("__at") / rows).cast("long")).drop("__at")


def padded(examples: DataFrame, batch: str, pad_id: int) -> DataFrame:
    """Rows right-padded to the longest of their `batch`: ids with `pad_id`, mask with 0, labels with -100.

    Only the length per batch is aggregated and joined back.
    """
    longest = examples.groupBy(batch).agg(F.max(F.size("input_ids")).alias("__most"))
    rows = examples.join(longest, batch)
    short = F.col("__most") - F.size("input_ids")
    fill = {"input_ids": pad_id, "attention_mask": 0, "labels": V.IGNORE_LABEL}
    return rows.withColumns(
        {name: F.concat(F.col(name), F.array_repeat(F.lit(v), short)) for name, v in fill.items()}
    ).drop("__most")
