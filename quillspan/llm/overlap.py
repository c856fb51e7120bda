"""Problem 1: the same or nearly the same records in evaluation and training splits.

Two texts overlap if at least four fifths of the words of each stand in the other.  The
k-th occurrence of a word is a token of its own, so texts are sets of tokens; written in
one common order they are strings whose edit distance (insertions and deletions) is
exactly the number of words that stand in one only.  The join is an edit-distance segment
join on these strings: an evaluation string that may lose k tokens is cut into k + 1
segments at its rare end, one of which must stand in the training string at an allowed
position; candidates are verified by banded dynamic programming.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.session import cut_lineage, spread

ORDER_BITS = 20
SKETCH_WORDS = 8
_BITS = 64 * SKETCH_WORDS
DP_CELLS = 40_000_000


def needed(n: int) -> int:
    """Least number of common words out of n: four fifths, rounded up."""
    return -(-4 * n // 5)


def _needed(n: Column) -> Column:
    return F.ceil(n * 4 / F.lit(5)).cast("int")


def spoken_words(messages: Column) -> Column:
    """Lower-cased contents of the turns whose role is not system, joined by blanks; null as empty."""
    turns = F.filter(messages, lambda t: F.trim(F.lower(F.coalesce(t["role"], F.lit("")))) != "system")
    return F.lower(F.array_join(F.transform(turns, lambda t: F.coalesce(t["content"], F.lit(""))), " "))


def tokens_of(text: str, seen: dict[tuple[str, int], int]) -> np.ndarray:
    """Sorted 64-bit tokens of a text: one for each occurrence of each word."""
    counts: dict[str, int] = {}
    out = []
    for word in text.split():
        k = counts.get(word, 0)
        counts[word] = k + 1
        token = seen.get((word, k))
        if token is None:
            if len(seen) > 300_000:
                seen.clear()
            token = seen[word, k] = xxhash.xxh64_intdigest(f"{k}\0{word}") - (1 << 63)
        out.append(token)
    found = np.array(out, dtype=np.int64)
    found.sort()
    return found


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], int] = {}
    for batch in batches:
        *keys, texts = batch.columns
        arrays = [tokens_of(t or "", seen) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, arrays)])
        flat = np.concatenate(arrays) if arrays else np.array([], dtype=np.int64)
        names = [xxhash.xxh3_128_digest(a.tobytes()) for a in arrays]
        tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(names, pa.binary()), tokens], names=[*batch.schema.names[:-1], "cls", "tokens"]
        )


def _strings(counts: np.ndarray):
    """The selective end of each class's string: (cls, n, at, token, sketch words) per segment.

    Tokens stand from rare to frequent by the count of their cell, in a cell by value.  The sketch has a bit for each residue of the tokens, set if an
    odd number of tokens have it: the bits in which two sketches differ are a lower bound
    of the edit distance.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(4 + SKETCH_WORDS)]
            for cls, tokens in zip(batch.column(0), batch.column(1), strict=True):
                own = tokens.values.to_numpy()
                n = len(own)
                string = own[np.argsort(counts[own & (len(counts) - 1)], kind="stable")]
                segments = n - needed(n) + 1
                odd = np.bincount((own & (_BITS - 1)).astype(np.int64), minlength=_BITS) & 1
                sketch = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
                out[0] += [cls.as_py()] * segments
                out[1] += [n] * segments
                out[2] += range(segments)
                out[3] += string[:segments].tolist()
                for i in range(SKETCH_WORDS):
                    out[4 + i] += [int(sketch[i])] * segments
            kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64()] + [pa.int64()] * SKETCH_WORDS
            names = ["cls", "n", "at", "token"] + [f"s{i}" for i in range(SKETCH_WORDS)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return cut


def common_tokens(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Common tokens of each pair of strings, by banded dynamic programming over all pairs at once.

    Exact where the pair overlaps enough (its path then stays in the band), else a number
    too small to overlap.
    """
    n = np.array([len(x) for x in a])
    m = np.array([len(x) for x in b])
    longest = np.maximum(n, m)
    width = int(np.max(n + m - 2 * -(-4 * longest // 5)).clip(0))
    rows, columns = int(n.max()), int(m.max())
    left = np.full((len(a), rows), -1, dtype=np.int64)
    # training strings, shifted so that band offset d of row i reads column i + d
    right = np.full((len(a), columns + 2 * width + rows + 2), -2, dtype=np.int64)
    alphabet = np.unique(np.concatenate([*a, *b]))
    for p, (x, y) in enumerate(zip(a, b, strict=True)):
        left[p, : len(x)] = np.searchsorted(alphabet, x)
        right[p, width : width + len(y)] = np.searchsorted(alphabet, y)
    band = np.zeros((len(a), 2 * width + 2), dtype=np.int32)
    found = np.zeros(len(a), dtype=np.int64)
    offset = m - n + width
    fits = (offset >= 0) & (offset <= 2 * width)
    for i in range(rows):
        equal = right[:, i : i + 2 * width + 1] == left[:, i : i + 1]
        step = np.maximum(band[:, 1:], band[:, :-1] + equal)
        np.maximum.accumulate(step, axis=1, out=band[:, :-1])
        band[:, -1] = band[:, -2]
        done = np.flatnonzero(fits & (n == i + 1))
        found[done] = band[done, offset[done]]
    return found


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = batch.column(2), batch.column(3)
        a = [x.values.to_numpy() for x in one]
        b = [x.values.to_numpy() for x in two]
        common = np.zeros(len(a), dtype=np.int64)
        size = np.array([max(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
        rows = np.argsort(size, kind="stable")
        at = 0
        while at < len(rows):
            most = int(size[rows[at]])
            if most * (most - needed(most)) * 4 > DP_CELLS:  # too many cells even in the band: too long for a band: merge the two sorted strings
                p = rows[at]
                common[p] = len(np.intersect1d(a[p], b[p], assume_unique=True))
                at += 1
                continue
            upto = min(at + 256, len(rows))
            while upto > at + 1 and size[rows[upto - 1]] > 1.3 * most + 16:
                upto -= 1
            part = rows[at:upto]
            common[part] = common_tokens([a[p] for p in part], [b[p] for p in part])
            at = upto
        n = np.array([len(x) for x in a], dtype=np.int64)
        m = np.array([len(x) for x in b], dtype=np.int64)
        good = pa.array((5 * common >= 4 * n) & (5 * common >= 4 * m))
        kept = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(common)], names=["cls_e", "cls_t", "common"]
        )
        yield kept.filter(good)


def token_order(classes: DataFrame, bits: int = ORDER_BITS) -> np.ndarray:
    """How many tokens of all classes fall into each of 2 ** `bits` cells (the low bits of a token).

    Bounded by the number of cells, 8 bytes each, whatever the corpus; any order does the
    same for the result, this one puts rare tokens first as far as cells tell them apart.
    """
    cell = F.col("token").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("cell")
    found = classes.select(F.explode("tokens").alias("token")).groupBy(cell).agg(F.count(F.lit(1)).alias("n")).toPandas()
    counts = np.zeros(1 << bits, dtype=np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts


def split_overlaps(df: DataFrame, key: str, text: Column, is_train: Column, is_eval: Column) -> DataFrame:
    """Distinct (train key, eval key) pairs, as `{key}_t` and `{key}_e`, whose texts overlap.

    `text` is split at blanks into words that are compared as they are.  Rows with a null
    key, and texts without words, pair with nothing; a key is no pair with itself.  Rows of
    equal words form one class: the join is over distinct classes, and pairs are expanded
    from classes at the end, so copies cost nothing before the result itself.
    """
    side = F.when(is_train, "t").when(is_eval, "e")
    rows = df.select(F.col(key), side.alias("side"), text.alias("__text"))
    rows = rows.where(F.col(key).isNotNull() & F.col("side").isNotNull())
    out = T.StructType(
        [
            rows.schema[key],
            T.StructField("side", T.StringType()),
            T.StructField("cls", T.BinaryType()),
            T.StructField("tokens", T.ArrayType(T.LongType())),
        ]
    )
    tokenised = cut_lineage(spread(rows).mapInArrow(_tokenised, out).where(F.size("tokens") > 0))
    members = tokenised.select(key, "side", "cls").distinct()
    classes = cut_lineage(
        tokenised.groupBy("cls").agg(
            F.first("tokens").alias("tokens"),
            F.bool_or(F.col("side") == "t").alias("train"),
            F.bool_or(F.col("side") == "e").alias("eval"),
        )
    )
    sketch = ", ".join(f"s{i} bigint" for i in range(SKETCH_WORDS))
    shape = f"cls binary, n int, at int, token bigint, {sketch}"
    cut = _strings(token_order(classes))
    evals = classes.where("eval").select("cls", "tokens").mapInArrow(cut, shape).alias("e")
    trains = classes.where("train").select("cls", "tokens").mapInArrow(cut, shape).alias("t")
    n, m = F.col("e.n"), F.col("t.n")
    most = F.greatest(n, m)
    least_common = _needed(most)
    reach = F.least("e.at", "t.at") + F.least(n - F.col("e.at"), m - F.col("t.at"))
    apart = sum(
        (F.bit_count(F.col(f"e.s{i}").bitwiseXOR(F.col(f"t.s{i}"))) for i in range(SKETCH_WORDS)), F.lit(0)
    )
    possible = (
        (F.col("e.token") == F.col("t.token"))
        & (least_common <= F.least(n, m))
        & (reach >= least_common)
        & (apart <= n + m - 2 * least_common)
        & (F.col("e.cls") != F.col("t.cls"))
    )
    candidates = evals.join(trains, possible).select(F.col("e.cls").alias("cls_e"), F.col("t.cls").alias("cls_t"))
    candidates = cut_lineage(candidates.distinct())
    one = classes.select(F.col("cls").alias("cls_e"), F.col("tokens").alias("one"))
    two = classes.select(F.col("cls").alias("cls_t"), F.col("tokens").alias("two"))
    both = candidates.join(one, "cls_e").join(two, "cls_t").select("cls_e", "cls_t", "one", "two")
    near = both.mapInArrow(_verified, "cls_e binary, cls_t binary, common bigint").select("cls_e", "cls_t")
    equal = classes.where("eval and train").select(F.col("cls").alias("cls_e"), F.col("cls").alias("cls_t"))
    pairs = near.union(equal)
    e = members.where("side = 'e'").select(F.col("cls").alias("cls_e"), F.col(key).alias(f"{key}_e"))
    t = members.where("side = 't'").select(F.col("cls").alias("cls_t"), F.col(key).alias(f"{key}_t"))
    found = pairs.join(e, "cls_e").join(t, "cls_t").where(F.col(f"{key}_e") != F.col(f"{key}_t"))
    return found.select(f"{key}_t", f"{key}_e").distinct()
