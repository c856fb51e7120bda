"""Byte-level BPE by a segment tree over adjacent pair ranks.

The vocabulary is a public one, read from a `.tiktoken` file whose path is a parameter.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterable, Sequence

import numpy as np
import regex

DEFAULT_VOCABULARY = os.environ.get("QUILLSPAN_BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# --- fixed values: the pre-tokenisation pattern of the vocabulary ----------------------
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NONE = 1 << 62
_POSITION_BITS = 32


class PairTree:
    """Minimum over the adjacent pairs of a symbol sequence, as (rank, position) in one integer.

    `root()` gives the leftmost pair of lowest rank; `put` changes one position in
    O(log n).
    """

    __slots__ = ("size", "nodes")

    def __init__(self, values: Sequence[int]):
        n = 1
        while n < len(values):
            n *= 2
        self.size = n
        nodes = [_NONE] * n + list(values) + [_NONE] * (n - len(values))
        for i in range(n - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left < right else right
        self.nodes = nodes

    def root(self) -> int:
        return self.nodes[1]

    def put(self, position: int, value: int) -> None:
        nodes = self.nodes
        i = self.size + position
        nodes[i] = value
        while i > 1:
            other = nodes[i ^ 1]
            best = value if value < other else other
            i //= 2
            if nodes[i] == best:
                break
            nodes[i] = value = best


class ByteBPE:
    """Encoder of one vocabulary, with bounded caches of what it has seen.

    Ids are those of the public tokenizer without special tokens; null and empty texts
    have none.  Caches are emptied when they reach `cache_entries`; they change the speed,
    never the result.
    """

    def __init__(self, path: str = DEFAULT_VOCABULARY, cache_entries: int = 400_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._find = regex.compile(PRETOKENS).findall
        self._limit = cache_entries
        self._words: dict[str, list[int]] = {}
        self._reset()

    # -- one pre-token -----------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        if n < 2:
            return [ranks[word]] if word else []
        after = list(range(1, n + 1))  # start of the next symbol
        before = list(range(-1, n - 1))
        get = ranks.get

        def pair(i: int) -> int:
            j = after[i]
            if j >= n:
                return _NONE
            rank = get(word[i : after[j]])
            return _NONE if rank is None else rank << _POSITION_BITS | i

        tree = PairTree([pair(i) for i in range(n)])
        mask = (1 << _POSITION_BITS) - 1
        while (best := tree.root()) != _NONE:
            i = best & mask
            j = after[i]
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
            tree.put(j, _NONE)
            tree.put(i, pair(i))
            if (h := before[i]) >= 0:
                tree.put(h, pair(h))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : after[i]]])
            i = after[i]
        return ids

    # -- texts -------------------------------------------------------------------------

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text."""
        out: list[int] = []
        words = self._words
        for word in self._find(text or ""):
            ids = words.get(word)
            if ids is None:
                if len(words) >= self._limit:
                    words.clear()
                ids = self.merge(word.encode())
                if len(word) <= 64:
                    words[word] = ids
            out += ids
        return out

    def _reset(self) -> None:
        self._heads = _Chunks(self, "")
        self._tails = _Chunks(self, " ")
        self._flat = array("i")
        self._start = array("q")
        self._size = array("i")

    def _add(self, chunk: str) -> int:
        ids = self.encode(chunk)
        self._start.append(len(self._flat))
        self._size.append(len(ids))
        self._flat.extend(ids)
        return len(self._size) - 1

    def _chunks(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all chunks in order, and the chunk count of each text.

        A token never spans the place between a non-blank character and a following
        blank, so a text can be cut before every such space and equal chunks share work.
        """
        if len(self._size) >= self._limit:
            self._reset()
        heads, tails = self._heads, self._tails
        numbers: list[int] = []
        counts = []
        for text in texts:
            if not text:
                counts.append(0)
                continue
            parts = _CUT(text)
            numbers.append(heads[parts[0]])
            numbers += [tails[p] for p in parts[1:]]
            counts.append(len(parts))
        return np.array(numbers, dtype=np.int64), np.array(counts, dtype=np.int64)

    def encode_batch(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of each text: one more than texts)."""
        numbers, counts = self._chunks(texts)
        size = _view(self._size)[numbers].astype(np.int64)
        first = _view(self._start)[numbers]
        ends = np.concatenate(([0], np.cumsum(size)))
        where = np.repeat(first - ends[:-1], size) + np.arange(ends[-1])
        return _view(self._flat)[where], ends[np.concatenate(([0], np.cumsum(counts)))]

    def count_batch(self, texts: Iterable[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        numbers, counts = self._chunks(texts)
        size = _view(self._size)[numbers].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        return np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])


def _view(numbers: array) -> np.ndarray:
    """The numbers without a copy; drop it before they grow."""
    return np.frombuffer(numbers, dtype=numbers.typecode) if len(numbers) else np.zeros(0, dtype=numbers.typecode)


_CUT = re.compile(r"(?<!\s) ").split


class _Chunks(dict):
    """Chunk text -> number, encoding what is new; `lead` stands before each chunk."""

    def __init__(self, owner: ByteBPE, lead: str):
        super().__init__()
        self._owner, self._lead = owner, lead

    def __missing__(self, chunk: str) -> int:
        number = self._owner._add(self._lead + chunk)
        if len(chunk) <= 256:
            self[chunk] = number
        return number


_encoders: dict[str, ByteBPE] = {}


def encoder(path: str) -> ByteBPE:
    """The encoder of a vocabulary in this process."""
    if path not in _encoders:
        _encoders[path] = ByteBPE(path)
    return _encoders[path]
