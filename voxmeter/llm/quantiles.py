"""Percentiles of huge numeric columns from mergeable sketches.

A sketch is a hierarchy of compactors. Level 0 holds values as they are; when the sketch is over its capacity, the
lowest full level is sorted and every second value, from a random start, moves one level up with twice the weight.
Capacities shrink by 2/3 a level below the top one, so a sketch of any number of values holds about 3k of them. Two
sketches merge level by level and are then compacted again.

Values are sketched where they are read, one sketch per group, part (a day, say) and task; only sketches are shuffled.
They are merged as a stream over sorted rows, so a group of any number of sketches needs memory for two. Random starts
come from a seed, the group and a counter: a repeated task gives the same sketch.

Compacting at level h moves the rank of any value by 2^h up or down with equal chance. A sketch therefore carries the sum
S of the squared weights of its compactions, and by Hoeffding's inequality each answered rank is off by at most
sqrt(2 S ln(2/delta)) with probability 1 - delta; S is 0, and the answer exact, while nothing has been compacted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import col

#: Capacity of the top compactor.
K = 512
#: Values that a task holds in open sketches before it hands them on.
OPEN_VALUES = 2_000_000
_SKETCH = "n bigint, lo double, hi double, s double, levels array<array<double>>"


class Sketch:
    __slots__ = ("k", "seed", "turns", "n", "lo", "hi", "s", "levels", "size")

    def __init__(self, k: int = K, seed: int = 0):
        self.k, self.seed, self.turns = k, seed, 0
        self.n, self.lo, self.hi, self.s, self.size = 0, math.inf, -math.inf, 0.0, 0
        self.levels: list[list[np.ndarray]] = [[]]

    def capacity(self, level: int) -> int:
        return max(8, math.ceil(self.k * (2 / 3) ** (len(self.levels) - 1 - level)))

    def limit(self) -> int:
        return sum(self.capacity(h) for h in range(len(self.levels)))

    def add(self, values: np.ndarray) -> None:
        """Finite values, in any number."""
        for i in range(0, len(values), self.k):
            part = values[i : i + self.k]
            self.n += len(part)
            self.lo, self.hi = min(self.lo, part.min()), max(self.hi, part.max())
            self.levels[0].append(part)
            self.size += len(part)
            self.compact()

    def merge(self, n: int, lo: float | None, hi: float | None, s: float, levels: Sequence[Sequence[float]]) -> None:
        if not n:
            return
        self.n += n
        self.s += s
        self.lo, self.hi = min(self.lo, lo), max(self.hi, hi)
        for h, values in enumerate(levels):
            if h == len(self.levels):
                self.levels.append([])
            if len(values):
                self.levels[h].append(np.asarray(values, np.float64))
                self.size += len(values)
        self.compact()

    def compact(self) -> None:
        while self.size > self.limit():
            for h in range(len(self.levels)):
                held = sum(map(len, self.levels[h]))
                if held <= self.capacity(h) or held < 2:
                    continue
                if h + 1 == len(self.levels):
                    self.levels.append([])
                values = np.sort(np.concatenate(self.levels[h]))
                rest = values[len(values) - len(values) % 2 :]
                start = xxhash.xxh3_64_intdigest(self.turns.to_bytes(8, "little"), self.seed) & 1
                self.turns += 1
                up = values[start : len(values) - len(rest) : 2]
                self.levels[h] = [rest] if len(rest) else []
                self.levels[h + 1].append(up)
                self.size -= len(up)
                self.s += 4.0**h
                break
            else:
                return

    def row(self) -> tuple:
        levels = [np.sort(np.concatenate(x)) if x else np.empty(0) for x in self.levels]
        return self.n, self.lo if self.n else None, self.hi if self.n else None, self.s, levels

    def weighted(self) -> tuple[np.ndarray, np.ndarray]:
        """Values in order and the ranks up to and with each."""
        parts = [(np.concatenate(x), 1 << h) for h, x in enumerate(self.levels) if x]
        values = np.concatenate([v for v, _ in parts])
        weights = np.concatenate([np.full(len(v), w, np.int64) for v, w in parts])
        order = np.argsort(values, kind="stable")
        return values[order], np.cumsum(weights[order])

    def quantiles(self, probabilities: Sequence[float]) -> list[float | None]:
        """For each probability p the value of rank ceil(p n), at least 1; null for an empty sketch."""
        if not self.n:
            return [None] * len(probabilities)
        values, ranks = self.weighted()
        wanted = [max(1, math.ceil(p * self.n)) for p in probabilities]
        at = np.minimum(np.searchsorted(ranks, wanted), len(values) - 1)
        return [float(self.lo if r == 1 else self.hi if r == self.n else values[i]) for r, i in zip(wanted, at)]

    def rank_error(self, delta: float) -> float:
        """Largest error of an answered rank as a share of n, kept with probability 1 - delta."""
        return min(1.0, math.sqrt(2 * self.s * math.log(2 / delta)) / self.n) if self.n else 0.0


def _seed(seed: int, *parts) -> int:
    return xxhash.xxh3_64_intdigest(repr(parts).encode(), seed)


def sketch_parts(df: DataFrame, groups: Sequence[str], part: str, value: str, k: int = K, seed: int = 0) -> DataFrame:
    """Sketches by group, part and task: (groups..., part, n, lo, hi, s, levels). Nothing is shuffled.

    Null, infinite and NaN values are none; a group without values keeps a sketch with n = 0. Null is a group of its
    own. Group and part columns keep their types.
    """
    keys = [*groups, part]
    rows = df.select(*(col(c) for c in keys), col(value).cast("double").alias("_v"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*(col(c) for c in keys)).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, handed = TaskContext.get().partitionId(), 0
        open_: dict[tuple, Sketch] = {}

        def close() -> pd.DataFrame:
            nonlocal handed
            handed += 1
            rows = [(*key, *sketch.row()) for key, sketch in open_.items()]
            open_.clear()
            return pd.DataFrame(rows, columns=[*keys, "n", "lo", "hi", "s", "levels"]).astype(object)

        for batch in batches:
            values = batch["_v"].to_numpy(np.float64, na_value=np.nan)
            for key, at in batch.groupby(keys, dropna=False, sort=False).indices.items():
                key = tuple(None if pd.isna(x) else x for x in (key if isinstance(key, tuple) else (key,)))
                if key not in open_:
                    # what a task has handed on counts, so that its next sketches toss other coins
                    open_[key] = Sketch(k, _seed(seed, task, handed, key))
                own = values[at]
                open_[key].add(own[np.isfinite(own)])
            if sum(s.size for s in open_.values()) > OPEN_VALUES:
                yield close()
        if open_:
            yield close()

    return rows.mapInPandas(run, f"{schema}, {_SKETCH}")


def _merged(sketches: DataFrame, keys: Sequence[str], k: int, seed: int, finish, schema: str) -> DataFrame:
    """Merges sketches of equal keys as a stream over sorted rows; finish makes the output columns of a merged one."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sketches.select(*(col(c) for c in keys)).schema.fields)
    names = [*keys, *(c.strip().split(" ")[0] for c in schema.replace("array<array<double>>", "x").split(","))]
    placed = sketches.select(*(col(c) for c in keys), "n", "lo", "hi", "s", "levels")
    placed = placed.repartition(*(col(c) for c in keys)).sortWithinPartitions(*(col(c) for c in keys), "n", "lo", "hi", "levels")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, sketch, done = None, None, []
        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                key = tuple(None if pd.isna(x) else x for x in row[: len(keys)])
                if current is None or key != current[0]:
                    if current:
                        done.append((*current[0], *finish(sketch)))
                    current, sketch = (key,), Sketch(k, _seed(seed, key))
                n, lo, hi, s, levels = row[len(keys) :]
                sketch.merge(int(n), lo, hi, s, levels)
            if len(done) > 1000:
                yield pd.DataFrame(done, columns=names).astype(object)
                done = []
        if current:
            done.append((*current[0], *finish(sketch)))
        if done:
            yield pd.DataFrame(done, columns=names).astype(object)

    return placed.mapInPandas(run, f"{types}, {schema}")


def merge_sketches(sketches: DataFrame, keys: Sequence[str], k: int = K, seed: int = 1) -> DataFrame:
    """One sketch per key from any number of them: of tasks, days, or earlier merges."""
    return _merged(sketches, keys, k, seed, Sketch.row, _SKETCH)


def percentiles(sketches: DataFrame, keys: Sequence[str], probabilities: Sequence[float], delta: float = 0.01, k: int = K, seed: int = 2) -> DataFrame:
    """Percentiles of each key over all its sketches: (keys..., n, p<100 p>..., rank_error).

    rank_error bounds the error of each rank as a share of n with probability 1 - delta. Without values n is 0 and the
    percentiles are null.
    """
    names = [f"p{100 * p:g}".replace(".", "_") for p in probabilities]

    def finish(sketch: Sketch) -> tuple:
        return (sketch.n, *sketch.quantiles(probabilities), sketch.rank_error(delta))

    return _merged(sketches, keys, k, seed, finish, ", ".join(["n bigint", *(f"{x} double" for x in names), "rank_error double"]))


def daily_sketches(df: DataFrame, groups: Sequence[str], time: str, value: str, k: int = K) -> DataFrame:
    """One sketch per group and day of time (null for rows without a time), in column day."""
    dated = df.select(*(col(c) for c in groups), F.to_date(col(time)).alias("day"), col(value).alias("_value"))
    return merge_sketches(sketch_parts(dated, groups, "day", "_value", k), [*groups, "day"], k)
