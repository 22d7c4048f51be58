"""Filling containers of fixed capacity with items of varying length.

Only the histogram of lengths, at most one number per length up to the capacity, comes to the driver. There the
configuration linear program (how often to use each combination of lengths that fits into one container, so that every
length is covered) is solved by multiplicative weights: a knapsack by dynamic programming over the capacity prices the
combinations from all lengths at once, those within a small share of the best price are used, and lengths that lag
behind gain weight for the next price. Every price also bounds the program from below; solving goes on, in finer steps,
until the gap between the two is small. The fractional solution is rounded down to whole containers; the remainder is
filled by priced combinations of what is left, the fullest first, or best fit if that needs fewer containers, all bins
that are alike at once. The driver's work depends on the capacity and the number of lengths, not on the number of items.

The plan is a list of combinations and how often each is used. Each item finds its container by its rank within its
length alone: ranks come from windows over hash buckets of a length, so a length that a third of all items share is
spread over many tasks, and the lookup is a binary search in the plan.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, checkpointed, col

CAPACITY = 2048
#: The gap to the dual bound, as a share of it, at which solving stops; the numbers of phases that are tried for it,
#: with the weight that a length gains when it lags one phase behind.
GAP, PHASES = 0.001, ((4, 0.05), (32, 0.5), (32, 0.2), (64, 0.1), (64, 0.05), (128, 0.02))
#: How far below the best price a combination may be.
SLACK = 0.002
#: Shares of the best price that a combination of the remainder must have, one pass after the other.
PASSES = (0.998, 0.99, 0.95, 0.8, 0.0)
#: Items of a length that one window may hold.
WINDOW_ROWS = 500_000


def prices(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The greatest value of a combination of any number of the sizes, for each room from 0 to capacity."""
    worth = np.zeros(capacity + 1)
    worth[sizes] = values
    best = np.zeros(capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = (worth[1 : room + 1] + best[room - 1 :: -1]).max()
    return best


def combination(first: int, sizes: np.ndarray, values: np.ndarray, left: np.ndarray, best: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, float]:
    """(indices, counts, value) of a combination with sizes[first], led by the prices of the room that remains.

    Only sizes of which something is left are taken, whole: as many as there are at most. Of equal values the longer
    size is taken.
    """
    room = len(best) - 1 - int(sizes[first])
    value = float(values[first])
    taken = {first: 1}
    open_ = left > 0
    open_[first] = not whole or left[first] > 1
    while True:
        n = int(np.searchsorted(sizes, room, side="right"))
        if not n:
            break
        worth = np.where(open_[:n], values[:n] + best[room - sizes[:n]], -1.0)
        i = n - 1 - int(worth[::-1].argmax())
        if worth[i] < 0:
            break
        taken[i] = taken.get(i, 0) + 1
        value += float(values[i])
        room -= int(sizes[i])
        if whole and taken[i] >= left[i]:
            open_[i] = False
    return np.fromiter(taken, np.int64), np.fromiter(taken.values(), np.int64), value


def configuration_lp(sizes: np.ndarray, amounts: np.ndarray, capacity: int, phases: int, gain: float, start: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], float, float, np.ndarray]:
    """(combinations with their fractional uses, their sum, the dual bound, values learnt): every size covered exactly.

    sizes ascend. In each phase every size may be covered up to an equal share of its amount. The value of a size is
    that of start times exp(gain * phases that it lags). A combination is used as far as its scarcest size goes if its
    value is within SLACK of the best price; sizes without one lag behind. After the last phase the sizes still open are
    priced alone until all are covered. The values learnt are the means of the later half, for finer steps to start from.
    """
    left = amounts.astype(float)
    share = left / phases
    uses: list[tuple[np.ndarray, np.ndarray, float]] = []
    used = bound = 0.0
    learnt, halves = np.zeros(len(sizes)), 0
    for phase in range(phases + len(sizes)):
        due = left - np.maximum(amounts - share * (phase + 1), 0)
        due[due < 1e-9 * amounts] = 0
        if phase >= phases:
            if not due.any():
                break
            values = np.where(due > 0, start, 0.0)
        else:
            values = start * np.exp(gain * (due / share - 1))
            if 2 * phase >= phases - 1:
                learnt, halves = learnt + np.log(values), halves + 1
            if phase == phases - 1:
                # the means waver less than the values of any phase, so they bound the program best
                learnt = np.exp(learnt / halves)
                bound = max(bound, float(learnt @ amounts) / prices(sizes, learnt, capacity)[capacity])
        best = prices(sizes, values, capacity)
        bound = max(bound, float(values @ amounts) / best[capacity])
        for i in np.argsort(-sizes):
            while due[i] > 0 and values[i] + best[capacity - sizes[i]] >= (1 - SLACK) * best[capacity]:
                index, counts, value = combination(i, sizes, values, due, best, False)
                if value < (1 - SLACK) * best[capacity]:
                    break
                step = float((due[index] / counts).min())
                uses.append((index, counts, step))
                used += step
                for a in (due, left):
                    a[index] -= step * counts
                    a[index[a[index] < 1e-9 * amounts[index]]] = 0
    return uses, used, bound, learnt


@dataclass(frozen=True)
class Plan:
    """Containers numbered from 0: configs[i] = ((size, count), ...) is used times[i] times in a row."""

    capacity: int
    configs: tuple[tuple[tuple[int, int], ...], ...]
    times: tuple[int, ...]
    #: No packing uses fewer containers than the dual bound of the linear program; value is what the program reached.
    bound: float = 0.0
    value: float = 0.0

    @property
    def containers(self) -> int:
        return sum(self.times)

    @property
    def least(self) -> int:
        """The dual bound in whole containers."""
        return int(np.ceil(self.bound - 1e-6))

    def slots(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each size, over the configurations with it: slots up to and with it, its first container, its times."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for config, times in zip(self.configs, self.times):
            for size, count in config:
                by.setdefault(size, []).append((count * times, first, times))
            first += times
        return {s: (np.cumsum([x[0] for x in rows]), np.array([x[1] for x in rows]), np.array([x[2] for x in rows])) for s, rows in by.items()}


def best_fit(sizes: list[int], capacity: int) -> list[dict[int, int]]:
    """Bins of items, each item, longest first, put where it leaves the least space."""
    bins: list[dict[int, int]] = []
    rooms: list[tuple[int, int]] = []
    for size in sorted(sizes, reverse=True):
        k = bisect_left(rooms, (size, -1))
        if k == len(rooms):
            bins.append({})
            room, b = capacity, len(bins) - 1
        else:
            room, b = rooms.pop(k)
        bins[b][size] = bins[b].get(size, 0) + 1
        insort(rooms, (room - size, b))
    return bins


def best_fit_groups(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The bins of best_fit() as (bin, how many alike), for size: amount; the work grows with the sizes alone.

    A bin that takes an item has the least room afterwards, so it goes on taking items of the size until none fits:
    all bins with the same room take the same, but for the last one.
    """
    groups: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def put(room: int, one: dict[int, int], n: int) -> None:
        if n > 0:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((one, n))

    for size in sorted(histogram, reverse=True):
        amount = histogram[size]
        while amount > 0:
            k = bisect_left(rooms, size)
            room = rooms[k] if k < len(rooms) else capacity
            each = room // size
            one, n = groups[room].pop() if k < len(rooms) else ({}, -(-amount // each))
            if k < len(rooms) and not groups[room]:
                del groups[room], rooms[k]
            full = min(n, amount // each)
            rest = min(amount - full * each, each) if full < n else 0
            put(room - each * size, one | {size: one.get(size, 0) + each}, full)
            if rest:
                put(room - rest * size, one | {size: one.get(size, 0) + rest}, 1)
            put(room, one, n - full - (rest > 0))
            amount -= full * each + rest
    return [x for room in rooms for x in groups[room]]


def _remainder(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins of what rounding leaves, as (bin, how many alike): priced combinations, or best fit where that needs fewer."""
    plain = best_fit_groups({int(s): int(n) for s, n in zip(sizes, left) if n}, capacity)
    mixed: list[tuple[dict[int, int], int]] = []
    values = sizes / capacity
    for least in PASSES:
        if not left.any():
            break
        live = left > 0
        best = prices(sizes[live], values[live], capacity)
        for i in np.argsort(-sizes):
            while left[i] > 0:
                index, counts, value = combination(i, sizes, values, left, best, True)
                if value < least * best[capacity]:
                    break
                n = int((left[index] // counts).min())
                left[index] -= n * counts
                mixed.append(({int(sizes[k]): int(c) for k, c in zip(index, counts)}, n))
    return min(plain, mixed, key=lambda groups: sum(n for _, n in groups))


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Plan:
    """A plan for items of 1..capacity, given as size: amount, of no more containers than best fit uses."""
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("sizes must be in 1..capacity")
    kept = sorted((s, n) for s, n in histogram.items() if n > 0)
    if not kept:
        return Plan(capacity, (), ())
    sizes, amounts = np.array([s for s, _ in kept], np.int64), np.array([n for _, n in kept], np.int64)
    solved, value, bound, values = None, float("inf"), 0.0, sizes / capacity
    for phases, gain in PHASES:
        uses, used, least, values = configuration_lp(sizes, amounts, capacity, phases, gain, values)
        bound = max(bound, least)
        if used < value:
            solved, value = uses, used
        if value <= (1 + gap) * bound + 0.5:
            break
    # equal combinations of several phases are one before they are rounded down
    total: dict[tuple[tuple[int, int], ...], float] = {}
    for index, counts, x in solved:
        config = tuple(sorted(zip(index.tolist(), counts.tolist())))
        total[config] = total.get(config, 0.0) + x
    left = amounts.copy()
    groups: list[tuple[dict[int, int], int]] = []
    for config, x in total.items():
        n = int(x + 1e-6)
        n = min([n, *(int(left[i]) // c for i, c in config)])
        if n > 0:
            for i, c in config:
                left[i] -= n * c
            groups.append(({int(sizes[i]): c for i, c in config}, n))
    groups += _remainder(sizes, left, capacity)
    # a program that has not converged is never worse than best fit
    plain = best_fit_groups(dict(kept), capacity)
    if sum(n for _, n in plain) < sum(n for _, n in groups):
        groups = plain
    return Plan(capacity, tuple(tuple(sorted(one.items())) for one, _ in groups), tuple(n for _, n in groups), bound, value)


def container_of(size: Column, rank: Column, plan: Plan) -> Column:
    """The container of the item with this size and rank, from 0, within its size."""
    slots = plan.slots()

    @F.pandas_udf("long")
    def at(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sizes, ranks in parts:
            sizes, ranks = sizes.to_numpy(), ranks.to_numpy()
            out = np.empty(len(sizes), np.int64)
            for s in np.unique(sizes):
                own = sizes == s
                ends, first, times = slots[int(s)]
                k = np.searchsorted(ends, ranks[own], side="right")
                before = np.concatenate(([0], ends[:-1]))[k]
                out[own] = first[k] + (ranks[own] - before) % times[k]
            yield pd.Series(out)

    return at(size, rank)


def pack_with_plan(df: DataFrame, id_col: str, size: Column, capacity: int = CAPACITY) -> tuple[DataFrame, Plan]:
    """The rows and the plan that they follow. Rows: (id, piece, start, tokens, container): one row per item, or per piece of an item longer than the capacity.

    Only those items are split, into pieces of the capacity and one rest. Items of size 0 or null take no space: piece
    0, no container. Every row is an item, repeated rows too. Containers are numbered from 0 without gaps and none holds
    more than the capacity. The sizes are computed once and written to the checkpoint folder.
    """
    sized = checkpointed(df.select(col(id_col).alias("_id"), F.coalesce(size.cast("long"), F.lit(0)).alias("_size")))
    last = F.greatest(F.ceil(F.col("_size") / capacity) - 1, F.lit(0))
    pieces = sized.select("_id", "_size", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("_piece")).select(
        "_id", "_piece", (F.col("_piece") * capacity).alias("_start"), F.least(F.lit(capacity), F.col("_size") - F.col("_piece") * capacity).alias("_tokens")
    )
    solid = pieces.where("_tokens > 0")
    histogram = {int(r["_tokens"]): int(r["n"]) for r in solid.groupBy("_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = pack_histogram(histogram, capacity)
    buckets = max(1, -(-max(histogram.values(), default=0) // WINDOW_ROWS))
    spread = solid.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_piece"), F.lit(buckets)))
    counts = spread.groupBy("_tokens", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_tokens").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tokens", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    ranked = spread.withColumn("_own", F.row_number().over(Window.partitionBy("_tokens", "_bucket").orderBy("_id", "_piece")) - 1)
    ranked = ranked.join(broadcast_if_small(offsets) if buckets > 1 else F.broadcast(offsets), ["_tokens", "_bucket"])
    placed = ranked.select("_id", "_piece", "_start", "_tokens", container_of(F.col("_tokens"), F.col("_own") + F.col("_offset"), plan).alias("container"))
    empty = pieces.where("_tokens <= 0").select("_id", "_piece", "_start", F.lit(0).cast("long").alias("_tokens"), F.lit(None).cast("long").alias("container"))
    rows = placed.unionByName(empty).select(
        F.col("_id").alias(id_col), F.col("_piece").alias("piece"), F.col("_start").alias("start"), F.col("_tokens").alias("tokens"), "container"
    )
    return rows, plan


def pack(df: DataFrame, id_col: str, size: Column, capacity: int = CAPACITY) -> DataFrame:
    """The rows of pack_with_plan()."""
    return pack_with_plan(df, id_col, size, capacity)[0]


def packing_summary(packed: DataFrame, plan: Plan) -> DataFrame:
    """One row: containers used, the least number by volume and by the dual bound, tokens, and the share of unused space."""
    whole = packed.where("container IS NOT NULL").agg(
        (F.coalesce(F.max("container"), F.lit(-1)) + 1).alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    )
    space = F.col("containers") * plan.capacity
    return whole.select(
        "containers", F.ceil(F.col("tokens") / plan.capacity).alias("least"), F.lit(plan.least).alias("dual_bound"), "tokens",
        F.coalesce(F.try_divide(space - F.col("tokens"), space), F.lit(0.0)).alias("unused"),
    )
