"""Token ids of a byte-level BPE vocabulary, by a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern. A batch's distinct pre-tokens go through a minimal perfect
hash over the vocabulary: those that are vocabulary entries get their id at once. The rest are merged by a heap of
adjacent pairs over a doubly linked list of bytes, O(n log n) in the pre-token's length, so one endless word is no
trap. Both tiers give the ids that the merge ranks define; a memo of bounded size only saves repeated work.

Encoding is a row-wise map: no shuffle, one Arrow batch at a time. Each Python worker builds the tables once.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import col

# Fixed value: the pattern that the vocabulary's merges were made for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Entries of a worker's memo of merged pre-tokens; it is emptied when full.
MEMO = 200_000


class PerfectHash:
    """A minimal perfect hash over byte strings: n keys fill n slots, each bucket has its own displacement.

    Keys are put into n/2 buckets by a 64-bit hash; the buckets, largest first, take the smallest displacement that
    sends all their keys to free slots; a bucket of one key names one of the slots that are left. An unknown key also
    gets a slot, so the slot's key must be compared.
    """

    _STEP, _MIX, _ALL = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 2)
        groups: dict[int, list[tuple[int, int]]] = {}
        for i, h in enumerate(self.hashes(keys).tolist()):
            groups.setdefault(h % self.buckets, []).append((h, i))
        self.displacement = np.zeros(self.buckets, np.int64)
        at = [-1] * n
        single = []
        for bucket, group in sorted(groups.items(), key=lambda x: -len(x[1])):
            if len(group) == 1:
                single.append((bucket, group[0][1]))
                continue
            for d in range(1, 1 << 20):
                step = d * self._STEP & self._ALL
                slots = [(((h ^ step) * self._MIX & self._ALL) >> 32) % n for h, _ in group]
                if len(set(slots)) == len(slots) and all(at[s] < 0 for s in slots):
                    break
            else:
                raise ValueError("two keys have the same hash")
            self.displacement[bucket] = d
            for s, (_, i) in zip(slots, group):
                at[s] = i
        free = iter([s for s in range(n) if at[s] < 0])
        for (bucket, i), s in zip(single, free):
            self.displacement[bucket] = -1 - s
            at[s] = i
        self.at = np.array(at, np.int64)

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """For each key the index of the only key that it can be."""
        if not keys or not self.n:
            return np.full(len(keys), -1, np.int64)
        hashes = self.hashes(keys)
        d = self.displacement[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        with np.errstate(over="ignore"):
            mixed = (hashes ^ (d.astype(np.uint64) * np.uint64(self._STEP))) * np.uint64(self._MIX)
        slots = np.where(d < 0, -1 - d, ((mixed >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64))
        return self.at[slots]


def read_ranks(path: str, content: bytes | None = None) -> dict[bytes, int]:
    """Byte strings and ranks of a vocabulary file, or of its content: lines of base64 and rank."""
    if content is None:
        with open(path, "rb") as f:
            content = f.read()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class Encoder:
    """Encodes texts with one vocabulary."""

    def __init__(self, path: str = DEFAULT_VOCABULARY, pattern: str = PATTERN, content: bytes | None = None):
        self.ranks = read_ranks(path, content)
        self.keys = list(self.ranks)
        self.ids = np.fromiter(self.ranks.values(), np.int64, len(self.keys))
        self.hash = PerfectHash(self.keys)
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, list[int]] = {}

    def merged(self, token: bytes) -> list[int]:
        """Ids of a pre-token that is no vocabulary entry: the pair of least rank, leftmost first, merges until none can."""
        ranks, n = self.ranks, len(token)
        parts = [token[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[p], i, i + 1, p) for i in range(n - 1) if (p := token[i : i + 2]) in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, j, whole = heapq.heappop(heap)
            # a pair is out of date once either of its parts has changed
            if parts[i] is None or right[i] != j or parts[j] is None or len(parts[i]) + len(parts[j]) != len(whole):
                continue
            parts[i], parts[j] = whole, None
            after = right[i] = right[j]
            if after < n:
                left[after] = i
                if (p := whole + parts[after]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, after, p))
            before = left[i]
            if before >= 0 and (p := parts[before] + whole) in ranks:
                heapq.heappush(heap, (ranks[p], before, i, p))
        return [ranks[p] for p in parts if p is not None]

    def _learn(self, tokens: list[str]) -> None:
        """Puts the ids of new pre-tokens into the memo: known entries by the hash, the others by merging."""
        raw = [t.encode() for t in tokens]
        found = self.hash.lookup(raw)
        keys, ids = self.keys, self.ids
        for t, b, k in zip(tokens, raw, found.tolist()):
            self.memo[t] = [int(ids[k])] if k >= 0 and keys[k] == b else self.merged(b)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; no special tokens; none for a null or empty text."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = {t for tokens in cut for t in tokens}.difference(self.memo)
        if new:
            self._learn(list(new))
        memo = self.memo
        return [[i for t in tokens for i in memo[t]] for tokens in cut]


_encoders: dict[str, Encoder] = {}
_sent: dict[tuple[str, str], Broadcast] = {}


def encoder(path: str = DEFAULT_VOCABULARY, content: bytes | None = None) -> Encoder:
    """The process's encoder of a vocabulary, built on first use, from the file's content if that is given."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, content=content)
    return _encoders[path]


def vocabulary(path: str) -> Broadcast:
    """The content of a vocabulary file, read by the driver and sent to every executor once; its size is the file's.

    Workers so need no copy of the file.
    """
    sc = SparkSession.active().sparkContext
    key = (sc.applicationId, path)
    if key not in _sent:
        with open(path, "rb") as f:
            _sent[key] = sc.broadcast(f.read())
    return _sent[key]


def _batches(texts: pd.Series, chars: int = 1 << 20) -> Iterator[list]:
    """Runs of texts of about so many characters, so that one batch of long texts doesn't fill the worker."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t) if t else 0
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def token_ids(text: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """Ids of a text column as an array of int; empty for null and empty texts."""

    sent = vocabulary(path)

    @F.pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path, sent.value)
        for part in parts:
            yield pd.Series([np.array(x, np.int32) for run in _batches(part) for x in e.encode(run)], dtype=object)

    return ids(text)


def token_count(text: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """Number of ids of a text column; 0 for null and empty texts."""

    sent = vocabulary(path)

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path, sent.value)
        for part in parts:
            yield pd.Series([len(x) for run in _batches(part) for x in e.encode(run)], dtype="int64")

    return count(text)


def decoded(ids: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """The text of an array of ids; empty for an empty array, null for null."""
    sent = vocabulary(path)

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path, sent.value)
        by_id = dict(zip(e.ids.tolist(), e.keys))
        for part in parts:
            yield pd.Series([None if x is None else b"".join(by_id[int(i)] for i in x).decode("utf-8", "replace") for x in part], dtype=object)

    return text(ids)


def encode_documents(df: DataFrame, id_col: str, text_col: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(id, ids) of every row, in place: repeated rows are encoded as often as they occur, other columns are dropped."""
    return df.select(col(id_col), token_ids(col(text_col), path).alias("ids"))
