"""Schemas that drift between files: one consistent table, and every change.

Each file of a stream is a version of a schema. One pass over the payloads profiles the columns of every file, nested
objects too: kinds of JSON values, how far numbers go with the length of the payload, and a sketch of the values (the k
with the least hashes, with their counts), which answers quantiles, frequent values and common values of two columns. A
file's profile also holds the records at its two ends, since a file may begin with those that closed the one before.
Files get their previous one by windows over the days of a stream and one row a day, so no stream goes through one task.

Neighbouring versions are matched by a bipartite matching of greatest similarity: of names, kinds, sketches, and of the
values of records that both files hold. A field is seeded where a stream begins with one of its documented names, and
carried from file to file by the matching, to the end of the stream, whatever the columns are called on the way. Names
that were carried to are learnt over all streams: they seed streams, or what comes back after a gap, and a name that
mostly stands beside the field's own column is none of its names. Changes of a field are read off its columns.
"""

from __future__ import annotations

import json
import math
import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, checkpointed, col, spread

#: Values of a column that its sketch keeps (a column of fewer is kept whole), and records of each end of a file.
VALUES, EDGE = 64, 4
#: Similarity from which two columns of neighbouring versions may be the same one.
LEAST = 1.0
#: Similarity from which two columns of one name are the same one: name and kind agree and the values don't contradict.
SURE = 5.0
#: Columns of files that a task profiles before it hands them on.
OPEN_COLUMNS = 20_000
KINDS = ("number", "text", "list", "boolean")


@dataclass(frozen=True)
class Field:
    """A wanted column with its documented names; numeric ones are measured in seconds."""

    name: str
    numeric: bool
    names: tuple[str, ...]


# The shipped and the default name of each field.
FIELDS = (
    Field("duration", True, ("audio_seconds", "gen_dur")),
    Field("latency", True, ("gen_seconds", "latency_s")),
    Field("voice", False, ("voice", "ref_voice")),
)


@lru_cache(100_000)
def name_words(path: str) -> tuple[str, ...]:
    """Lower-case words of a path, cut at dots, underscores and changes of case."""
    return tuple(w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", path).lower()) if w)


def assign(costs: list[list[float]]) -> list[int]:
    """The column of each row in a minimum-cost matching; there must be at least as many columns as rows.

    Shortest augmenting paths with potentials, cubic in the number of rows.
    """
    n = len(costs)
    m = len(costs[0]) if n else 0
    inf = float("inf")
    u, v, row_of = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], j = i, 0
        least, way, used = [inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[j]:
            used[j] = True
            r, delta, nxt = row_of[j], inf, 0
            for k in range(1, m + 1):
                if not used[k]:
                    c = costs[r - 1][k - 1] - u[r] - v[k]
                    if c < least[k]:
                        least[k], way[k] = c, j
                    if least[k] < delta:
                        delta, nxt = least[k], k
            for k in range(m + 1):
                if used[k]:
                    u[row_of[k]] += delta
                    v[k] -= delta
                else:
                    least[k] -= delta
            j = nxt
        while j:
            row_of[j] = row_of[way[j]]
            j = way[j]
    out = [-1] * n
    for k in range(1, m + 1):
        if row_of[k]:
            out[row_of[k] - 1] = k - 1
    return out


# --- values and profiles -----------------------------------------------------------------------------------------

_NUMBER = re.compile(r"(?:(ms|s):)?\s*(-?[0-9]+(?:[.,][0-9]+)?(?:[eE][-+]?[0-9]+)?)\s*(ms|s)?")


def reading(value) -> tuple[str, str, float | None, bool] | None:
    """(kind, text, number, has a unit) of a JSON value; None for null. A list counts by its first element.

    A number in a text may have a decimal comma and a unit (s or ms), before a colon or behind; milliseconds become
    seconds.
    """
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean", "true" if value else "false", None, False
    if isinstance(value, (int, float)):
        return "number", repr(value), float(value), False
    if isinstance(value, str):
        m = _NUMBER.fullmatch(value)
        if not m:
            return "text", value, None, False
        unit = m[1] or m[3]
        x = float(m[2].replace(",", "."))
        return "text", value, x / 1000 if unit == "ms" else x, unit is not None
    first = reading(value[0]) if value and not isinstance(value[0], dict) else None
    return ("list", first[1], first[2], first[3]) if first else ("list", json.dumps(value), None, False)


def flat(value: dict, prefix: str = "") -> Iterator[tuple[str, object]]:
    """(path, value) of everything in an object that is no object itself; paths are dotted, to any depth."""
    open_ = [(prefix, value)]
    while open_:
        prefix, value = open_.pop()
        for k, v in value.items():
            if isinstance(v, dict):
                open_.append((f"{prefix}{k}.", v))
            else:
                yield prefix + k, v


def _no_constant(name: str):
    raise ValueError(name)


def parsed(payload: str | None) -> dict | None:
    """The object of a payload, or None if it isn't one."""
    try:
        value = json.loads(payload, parse_constant=_no_constant)
    except (ValueError, TypeError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def key_of(text: str, number: float | None) -> str:
    """What values are compared by: numbers to six digits, long texts by their hash."""
    if number is not None:
        return f"{number:.6g}"
    return text if len(text) <= 32 else xxhash.xxh3_64_hexdigest(text)


def _hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key)


class Profile:
    """What is kept of a column: counts by kind, moments of its numbers and the payload lengths, a sketch of the values."""

    __slots__ = ("kinds", "numbers", "units", "moments", "values", "bound")

    def __init__(self) -> None:
        self.kinds, self.numbers, self.units, self.moments, self.values, self.bound = [0] * len(KINDS), 0, 0, [0.0] * 5, {}, None

    def __reduce__(self):
        return _profile, (self.kinds, self.numbers, self.units, self.moments, self.values, self.bound)

    def add(self, kind: str, key: str, number: float | None, unit: bool, size: int) -> None:
        self.kinds[KINDS.index(kind)] += 1
        if number is not None and abs(number) < 1e100:
            self.numbers += 1
            self.units += unit
            m = self.moments
            m[0] += number
            m[1] += number * number
            m[2] += size
            m[3] += size * size
            m[4] += number * size
        if key in self.values:
            self.values[key] += 1
        elif self.bound is None or _hash(key) <= self.bound:
            self.values[key] = 1
            if len(self.values) >= 2 * VALUES:
                self._shrink()

    def _shrink(self) -> None:
        if len(self.values) > VALUES:
            kept = sorted((_hash(k), k) for k in self.values)[:VALUES]
            self.bound = kept[-1][0]
            self.values = {k: self.values[k] for _, k in kept}

    def merge(self, other: "Profile") -> None:
        """Adds a profile of other rows; the sketch is the same in whatever order rows and profiles come."""
        self.kinds = [a + b for a, b in zip(self.kinds, other.kinds)]
        self.numbers += other.numbers
        self.units += other.units
        self.moments = [a + b for a, b in zip(self.moments, other.moments)]
        bounds = [b for b in (self.bound, other.bound) if b is not None]
        if bounds:
            self.bound = min(bounds)
        for k, n in other.values.items():
            self.values[k] = self.values.get(k, 0) + n
        if self.bound is not None:
            self.values = {k: n for k, n in self.values.items() if _hash(k) <= self.bound}
        self._shrink()

    @property
    def n(self) -> int:
        return sum(self.kinds)

    @property
    def kind(self) -> str:
        return KINDS[max(range(len(KINDS)), key=lambda i: (self.kinds[i], -i))]

    @property
    def distinct(self) -> float:
        return len(self.values) if self.bound is None else (len(self.values) - 1) * 2.0**64 / self.bound

    @property
    def length_correlation(self) -> float:
        """How far the numbers go with the length of their payload, -1 to 1."""
        x, xx, s, ss, xs = self.moments
        n = self.numbers
        spread_ = (n * xx - x * x) * (n * ss - s * s)
        return max(-1.0, min(1.0, (n * xs - x * s) / math.sqrt(spread_))) if n > 2 and spread_ > 1e-9 else 0.0

    def quantiles(self, points: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> list[float]:
        """Quantiles of the numbers, from the sketch: its values are a sample of the distinct ones, with their counts."""
        held = sorted((x, n) for k, n in self.values.items() if (x := _number(k)) is not None)
        if not held:
            return []
        ends, total = [], 0
        for _, n in held:
            total += n
            ends.append(total)
        return [held[min(len(held) - 1, bisect_left(ends, p * total))][0] for p in points]


def _profile(*parts) -> Profile:
    p = Profile()
    p.kinds, p.numbers, p.units, p.moments, p.values, p.bound = parts
    return p


class Version:
    """The profile of a file: stream, time, columns by path, records by line at either end, and payloads refused."""

    __slots__ = ("stream", "at", "columns", "ends", "rejects")

    def __init__(self) -> None:
        self.stream, self.at, self.columns, self.ends, self.rejects = None, None, {}, {}, 0

    def __reduce__(self):
        return _version, (self.stream, self.at, self.columns, self.ends, self.rejects)

    def add(self, stream, at, line: int | None, payload: str | None) -> None:
        self._place(stream, at)
        value = parsed(payload)
        if value is None:
            self.rejects += 1
            return
        record, size = {}, len(payload)
        for path, v in flat(value):
            read = reading(v)
            if read:
                kind, text, number, unit = read
                key = record[path] = key_of(text, number)
                if path not in self.columns:
                    self.columns[path] = Profile()
                self.columns[path].add(kind, key, number, unit, size)
        if line is not None:
            self.ends[line] = record
            if len(self.ends) > 4 * EDGE:
                self._shrink()

    def _place(self, stream, at) -> None:
        # of several values in one file the least counts
        if stream is not None and (self.stream is None or stream < self.stream):
            self.stream = stream
        if at is not None and (self.at is None or at < self.at):
            self.at = at

    def _shrink(self) -> None:
        if len(self.ends) > 2 * EDGE:
            lines = sorted(self.ends)
            self.ends = {k: self.ends[k] for k in lines[:EDGE] + lines[-EDGE:]}

    def merge(self, other: "Version") -> None:
        self._place(other.stream, other.at)
        self.rejects += other.rejects
        for path, p in other.columns.items():
            if path in self.columns:
                self.columns[path].merge(p)
            else:
                self.columns[path] = p
        self.ends |= other.ends
        self._shrink()

    def head(self) -> list[dict]:
        return [self.ends[k] for k in sorted(self.ends)[:EDGE]]

    def tail(self) -> list[dict]:
        return [self.ends[k] for k in sorted(self.ends)[-EDGE:]]


def _version(*parts) -> Version:
    v = Version()
    v.stream, v.at, v.columns, v.ends, v.rejects = parts
    return v


# --- matching ----------------------------------------------------------------------------------------------------


@lru_cache(100_000)
def _number(key: str) -> float | None:
    return float(key) if _NUMBER.fullmatch(key) else None


def _same(a: str, b: str) -> bool:
    """Whether two compared values are one, perhaps in another unit."""
    if a == b:
        return True
    x, y = _number(a), _number(b)
    if x is None or y is None:
        return False
    return abs(x - y) <= 0.0011 or abs(x - 1000 * y) <= 1.1 or abs(1000 * x - y) <= 1.1


def shared_records(now: Version, before: Version) -> list[tuple[dict, dict]]:
    """Pairs of a record at the beginning of a file and one at the end of that before it that are the same one.

    They agree in more than half of their telling values: texts of columns that hardly repeat themselves. Names of
    columns play no part.
    """

    def telling(v: Version, record: dict) -> set[str]:
        return {k for p, k in record.items() if p in varied[id(v)] and len(k) > 1 and _number(k) is None}

    varied = {id(v): {p for p, c in v.columns.items() if 2 * c.distinct > c.n} for v in (now, before)}

    ends = [(r, telling(before, r)) for r in before.tail()]
    out = []
    for r in now.head():
        own = telling(now, r)
        best = max(ends, key=lambda e: len(own & e[1]), default=None)
        if best and 2 * len(own & best[1]) > min(len(own), len(best[1])):
            out.append((r, best[0]))
    return out


@lru_cache(100_000)
def name_similarity(a: str, b: str) -> float:
    wa, wb = set(name_words(a)), set(name_words(b))
    return 2.0 * len(wa & wb) / (len(wa) + len(wb)) if wa or wb else 1.0


class Shape:
    """What two columns are compared by, drawn from a profile once."""

    __slots__ = ("path", "kind", "n", "varied", "distinct", "numeric", "numbers", "values", "logs", "r")

    def __init__(self, path: str, p: Profile) -> None:
        self.path, self.kind, self.n, self.distinct, self.numbers, self.values = path, p.kind, p.n, p.distinct, p.numbers, p.values
        self.varied = self.distinct / self.n
        self.numeric = 2 * p.numbers > p.n
        # decimal logarithms of the quantiles
        self.logs = [math.log10(max(abs(x), 1e-4)) for x in p.quantiles()] if self.numeric else []
        self.r = p.length_correlation if self.numeric else 0.0


def _distance(a: list[float], b: list[float]) -> float:
    """Mean distance of two lists of logarithms of quantiles; units of s and ms are one."""
    gaps = [x - y for x, y in zip(a, b)]
    near = 0.0 if abs(gaps[2]) < 1.5 else 3.0 if gaps[2] > 0 else -3.0
    return sum(abs(g - near) for g in gaps) / len(gaps) + 0.02 * abs(near)


def similarity(a: Shape, b: Shape, equal: int = 0, shared: int = 0) -> float:
    """How likely two columns of neighbouring versions are the same one."""
    score = 1.5 * name_similarity(a.path, b.path) + (3.0 if a.path == b.path else 0.0)
    if a.kind == b.kind:
        score += 0.5
    if a.n > 2 and b.n > 2:
        # constant columns and changing ones are different things
        score -= 2.0 * abs(a.varied - b.varied)
    if a.numeric != b.numeric:
        score += 0.5 if max(a.distinct, b.distinct) <= 2 else -1.0
    else:
        least = min(len(a.values), len(b.values))
        common = len(a.values.keys() & b.values.keys()) / least if least else 0.0
        if not a.numeric:
            score += 3.0 * common if least <= 2 or common > 0.5 else common
        else:
            if a.logs and b.logs:
                weight = min(1.0, min(a.numbers, b.numbers) / 8)
                score += weight * (2.5 - min(4.0, 8 * _distance(a.logs, b.logs)) - 1.5 * abs(a.r - b.r))
            score += common if least <= 4 else 0.0
    if shared:
        # what turns from text to number has other values
        score += 4.0 * equal / shared - (0.5 if a.numeric != b.numeric else 3.0) * (1 - equal / shared)
    return score


def versions_matched(now: Version, before: Version, least: float = LEAST) -> dict[str, str]:
    """path now: path before, by the matching of two versions; pairs below least are additions and removals.

    Only columns that aren't surely the same go through the matching, whose cost is cubic in their number.
    """
    if not now.columns or not before.columns:
        return {}
    pairs = shared_records(now, before)
    rows = {p: Shape(p, c) for p, c in now.columns.items()}
    cols = {p: Shape(p, c) for p, c in before.columns.items()}

    def likeness(a: Shape, b: Shape) -> float:
        both = [(x[a.path], y[b.path]) for x, y in pairs if a.path in x and b.path in y]
        return similarity(a, b, sum(_same(x, y) for x, y in both), len(both))

    # columns of one name whose values agree as well need no weighing against others; mostly these are nearly all
    sure = {p: p for p in rows.keys() & cols.keys() if likeness(rows[p], cols[p]) >= SURE}
    left, right = ([s for p, s in sorted(side.items()) if p not in sure] for side in (rows, cols))
    if not left or not right:
        return sure
    costs = [[-likeness(a, b) for b in right] + [-least] * len(left) for a in left]
    return sure | {a.path: right[k].path for a, k in zip(left, assign(costs)) if k < len(right)}


def seeds(version: Version, fields: Sequence[Field] = FIELDS) -> dict[str, str]:
    """path: field, by the matching of a version's columns to the fields whose documented names they have in some form."""
    columns = sorted(version.columns)

    def score(path: str, f: Field) -> float:
        p = version.columns[path]
        fits = max(name_similarity(path, n) + (path == n) for n in f.names)
        if f.numeric and 2 * p.numbers < p.n or not f.numeric and p.kind == "boolean":
            return -1.0
        return fits + 0.1 * math.tanh(p.n / 100)

    costs = [[-score(c, f) for c in columns] + [-0.99] * len(fields) for f in fields]
    return {columns[k]: f.name for f, k in zip(fields, assign(costs)) if k < len(columns)} if columns else {}


# --- the operator ------------------------------------------------------------------------------------------------


def _own(x):
    return None if x is None or x != x else x


def _profiled(rows: DataFrame, file_type: str) -> DataFrame:
    """(file, version) from rows (file, stream, at, line, payload): pickled profiles of each task's share of a file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def close() -> pd.DataFrame:
            out = pd.DataFrame([(f, pickle.dumps(v, 5)) for f, v in held.items()], columns=["file", "version"])
            held.clear()
            return out

        for batch in batches:
            for file, stream, at, line, payload in batch.itertuples(index=False, name=None):
                if file not in held:
                    held[file] = Version()
                line = _own(line)
                held[file].add(_own(stream), _own(at), None if line is None else int(line), _own(payload))
            if sum(len(v.columns) + 1 for v in held.values()) > OPEN_COLUMNS:
                yield close()
        if held:
            yield close()

    return rows.mapInPandas(run, f"file {file_type}, version binary")


def _merged(parts: DataFrame, file_type: str) -> DataFrame:
    """One row a file: (file, stream, at, version). Shares of a file are merged as a stream over sorted rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, whole, done = None, None, []

        def row() -> tuple:
            return current, whole.stream, whole.at, pickle.dumps(whole, 5)

        for batch in batches:
            for file, blob in batch.itertuples(index=False, name=None):
                version = pickle.loads(blob)
                if whole is not None and file == current:
                    whole.merge(version)
                    continue
                if whole is not None:
                    done.append(row())
                current, whole = file, version
            if len(done) > 500:
                yield pd.DataFrame(done, columns=["file", "stream", "at", "version"])
                done = []
        if whole is not None:
            done.append(row())
        if done:
            yield pd.DataFrame(done, columns=["file", "stream", "at", "version"])

    return parts.repartition("file").sortWithinPartitions("file").mapInPandas(run, f"file {file_type}, stream string, at string, version binary")


def previous_files(files: DataFrame) -> DataFrame:
    """(file, before) from (file, stream, at): the one before in its stream by time, null for the first; ties by id."""
    files = files.select("file", "stream", "at", F.substring("at", 1, 10).alias("day"))
    within = files.withColumn("inner", F.lag("file").over(Window.partitionBy("stream", "day").orderBy("at", "file")))
    days = files.groupBy("stream", "day").agg(F.max_by("file", F.struct("at", "file")).alias("last"))
    days = days.select("stream", "day", F.lag("last").over(Window.partitionBy("stream").orderBy("day")).alias("outer"))
    joined = within.alias("w").join(days.alias("d"), F.col("w.stream").eqNullSafe(F.col("d.stream")) & F.col("w.day").eqNullSafe(F.col("d.day")))
    return joined.select("file", F.coalesce("inner", "outer").alias("before"))


def _linked(versions: DataFrame, file_type: str, fields: Sequence[Field]) -> DataFrame:
    """For each file its columns, each with the one before that it is matched to and the field that its name speaks for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file, before, blob, old_blob in batch.itertuples(index=False, name=None):
                now, old = pickle.loads(blob), pickle.loads(old_blob) if old_blob is not None else None
                links = versions_matched(now, old) if old else {}
                named = seeds(now, fields)
                nodes, changes = [], []
                for path, p in sorted(now.columns.items()):
                    was = links.get(path)
                    middle = p.quantiles((0.5,))
                    in_ms = 2 * p.units < p.numbers and (name_words(path)[-1:] == ("ms",) or bool(middle) and middle[0] >= 100)
                    nodes.append((path, p.kind, p.n, was, named.get(path), 0.001 if in_ms else 1.0))
                    if old is not None and was is None:
                        changes.append((path, None, "added"))
                    elif was is not None:
                        changes += [(path, was, "renamed")] * (path != was) + [(path, was, "retyped")] * (p.kind != old.columns[was].kind)
                if old is not None:
                    changes += [(None, p, "removed") for p in sorted(old.columns.keys() - links.values())]
                rows.append((file, _own(before), nodes, changes))
            yield pd.DataFrame(rows, columns=["file", "before", "nodes", "changes"]).astype({"before": object})

    return versions.select("file", "before", "version", "old").mapInPandas(
        run,
        f"file {file_type}, before {file_type}, nodes array<struct<path string, kind string, n bigint, was string, named string, scale double>>, "
        "changes array<struct<path string, old_path string, change string>>",
    )


def _rooted(nodes: DataFrame) -> DataFrame:
    """nodes (file, path, ..., r_file, r_path, done) with r_file and r_path led to the first column of their run.

    A column points to the one it is matched to in the file before. Pointers double each round, so there are as many
    rounds as the logarithm of the longest run.
    """
    while nodes.where("NOT done").limit(1).count():
        to = nodes.select(F.col("file").alias("_f"), F.col("path").alias("_p"), F.col("r_file").alias("_rf"), F.col("r_path").alias("_rp"), F.col("done").alias("_d"))
        far = nodes.where("NOT done").drop("done").join(to, (F.col("r_file") == F.col("_f")) & (F.col("r_path") == F.col("_p")))
        far = far.withColumns({"r_file": F.col("_rf"), "r_path": F.col("_rp")}).withColumnRenamed("_d", "done").drop("_f", "_p", "_rf", "_rp")
        nodes = checkpointed(nodes.where("done").unionByName(far))
    return nodes


def _votes(labelled: DataFrame) -> DataFrame:
    """(path, field, pro, con): in how many files a name carries the field, and stands beside the column that does."""
    per = labelled.groupBy("file").agg(F.collect_list(F.struct("path", "label")).alias("own"))
    said = F.flatten(F.transform("own", lambda x: F.transform(
        F.filter("own", lambda y: y["label"].isNotNull() & ((y["path"] == x["path"]) | ~x["label"].eqNullSafe(y["label"]))),
        lambda y: F.struct(x["path"].alias("path"), y["label"].alias("field"), (y["path"] == x["path"]).alias("pro")),
    )))
    return per.select(F.explode(said).alias("v")).groupBy("v.path", "v.field").agg(F.count_if("v.pro").alias("pro"), F.count_if(~F.col("v.pro")).alias("con"))


def _labelled(nodes: DataFrame) -> DataFrame:
    """nodes with label, the field that a column carries, or null.

    A run takes the field that its first column's name speaks for. Names that runs were carried to are learnt, and runs
    without a field take that of any of their names, until nothing is new. A name that stands beside the field's own
    column at least as often as it carries the field doesn't carry it.
    """
    first = nodes.where("file = r_file AND path = r_path AND named IS NOT NULL").select(F.col("r_file").alias("_rf"), F.col("r_path").alias("_rp"), F.col("named").alias("_label"))
    roots = checkpointed(first)
    while True:
        labelled = nodes.join(roots, (F.col("r_file") == F.col("_rf")) & (F.col("r_path") == F.col("_rp")), "left").withColumn("label", F.col("_label")).drop("_rf", "_rp", "_label")
        labelled = checkpointed(labelled)
        votes = _votes(labelled).select(F.col("path").alias("_p"), F.col("field").alias("_field"), "pro", "con")
        votes = checkpointed(votes)
        open_ = labelled.where("label IS NULL")
        by_name = open_.where("named IS NOT NULL").select("r_file", "r_path", F.col("named").alias("_field"), F.lit(1 << 40).alias("pro"))
        learnt = open_.join(votes.where("pro > con"), F.col("path") == F.col("_p")).select("r_file", "r_path", "_field", "pro")
        new = by_name.unionByName(learnt).groupBy("r_file", "r_path", "_field").agg(F.sum("pro").alias("n"))
        new = new.groupBy(F.col("r_file").alias("_rf"), F.col("r_path").alias("_rp")).agg(F.max_by("_field", F.struct("n", "_field")).alias("_label"))
        new = checkpointed(new)
        if not new.limit(1).count():
            break
        roots = checkpointed(roots.unionByName(new))
    false = votes.where("con >= pro").select("_p", "_field", F.lit(True).alias("_false"))
    judged = labelled.join(false, (F.col("path") == F.col("_p")) & (F.col("label") == F.col("_field")), "left")
    return judged.withColumn("label", F.when(F.col("_false").isNull() | F.col("named").eqNullSafe(F.col("label")), F.col("label"))).drop("_p", "_field", "_false")


_CARRIERS = "array<struct<field:string,path:string,kind:string,scale:double>>"


@dataclass(frozen=True)
class Drift:
    """The drift of the files in a table of raw payloads.

    raw: a row per record, with the id, stream and time of its file, its line in it, and a JSON payload; key_path is the
    payload's path that names a record in the unified table. Of several streams or times of one file the least counts.
    Payloads that don't parse, or aren't objects, are rejects and speak for no column. Repeated rows change nothing that
    is reported. Rows without a file id are left out; further columns of raw are ignored. A field that a stream never has
    under a documented name, or one learnt from other streams, stays unknown in it.
    """

    raw: DataFrame
    file_id: str = "file_id"
    stream: str = "stream"
    time: str = "produced_at"
    line: str = "line_no"
    payload: str = "payload"
    key_path: str = "utt"
    fields: Sequence[Field] = FIELDS

    def _type(self) -> str:
        return self.raw.select(col(self.file_id)).schema[0].dataType.simpleString()

    def versions(self) -> DataFrame:
        """(file, stream, at, version): one profile a file, from one pass over the payloads."""
        rows = self.raw.where(col(self.file_id).isNotNull()).select(
            col(self.file_id).alias("file"), col(self.stream).cast("string").alias("stream"), col(self.time).cast("string").alias("at"),
            col(self.line).cast("bigint").alias("line"), col(self.payload).alias("payload"),
        )
        return _merged(_profiled(spread(rows), self._type()), self._type())

    def linked(self) -> DataFrame:
        """(file, before, nodes, changes): every file's columns with those before that they are matched to."""
        versions = checkpointed(self.versions())
        before = previous_files(versions)
        old = versions.select(F.col("file").alias("before"), F.col("version").alias("old"))
        return checkpointed(_linked(versions.join(before, "file").join(old, "before", "left"), self._type(), self.fields))

    def assigned(self) -> DataFrame:
        """(file, before, carriers, changes) of every file."""
        files = self.linked()
        nodes = files.select("file", "before", F.explode("nodes").alias("x")).select("file", "before", "x.*")
        own = F.col("was").isNull()
        nodes = nodes.select(
            "file", "path", "kind", "n", "named", "scale",
            F.when(own, F.col("file")).otherwise(F.col("before")).alias("r_file"), F.coalesce("was", "path").alias("r_path"), own.alias("done"),
        )
        labelled = _labelled(_rooted(checkpointed(nodes)))
        # of several columns that carry a field, one that has its name, then that of most values
        best = F.max_by(F.struct(F.col("label").alias("field"), "path", "kind", "scale"), F.struct(F.col("named").eqNullSafe(F.col("label")), "n", "path")).alias("c")
        carriers = labelled.where("label IS NOT NULL").groupBy("file", "label").agg(best).groupBy("file").agg(F.sort_array(F.collect_list("c")).alias("carriers"))
        return files.select("file", "before", "changes").join(carriers, "file", "left").withColumn("carriers", F.coalesce("carriers", F.array().cast(_CARRIERS)))

    def changes(self) -> DataFrame:
        """(file_id, field, change) for the wanted fields: added, removed, renamed, retyped."""
        a = checkpointed(self.assigned().select("file", "before", "carriers"))
        joined = a.where("before IS NOT NULL").join(a.select(F.col("file").alias("before"), F.col("carriers").alias("old")), "before")
        rows = []
        for f in self.fields:
            def carrier(c: str, f=f) -> Column:
                return F.get(F.filter(c, lambda x: x["field"] == f.name), F.lit(0))

            rows.append(F.struct(F.lit(f.name).alias("field"), carrier("carriers").alias("n"), carrier("old").alias("o")))
        pairs = joined.select(F.col("file").alias(self.file_id), F.explode(F.array(*rows)).alias("x")).select(self.file_id, "x.*")
        both = F.col("n").isNotNull() & F.col("o").isNotNull()
        change = F.array_compact(F.array(
            F.when(F.col("n").isNotNull() & F.col("o").isNull(), "added"),
            F.when(F.col("n").isNull() & F.col("o").isNotNull(), "removed"),
            F.when(both & (F.col("n.path") != F.col("o.path")), "renamed"),
            F.when(both & (F.col("n.kind") != F.col("o.kind")), "retyped"),
        ))
        return pairs.select(self.file_id, "field", F.explode(change).alias("change"))

    def all_changes(self) -> DataFrame:
        """(file_id, path, old_path, change) of every column, side fields too, as the matching of versions has them."""
        return self.linked().select(F.col("file").alias(self.file_id), F.explode("changes").alias("c")).select(self.file_id, "c.path", "c.old_path", "c.change")

    def _records(self) -> DataFrame:
        return self.raw.where(col(self.file_id).isNotNull()).select(col(self.file_id).alias("file"), col(self.line).alias("line"), col(self.payload).alias("payload"))

    def rejects(self) -> DataFrame:
        """(file_id, line_no, payload) of the rows that don't parse or are no objects; exact duplicates count once."""

        @F.pandas_udf("boolean")
        def refused(payloads: pd.Series) -> pd.Series:
            return payloads.map(lambda p: parsed(_own(p)) is None).astype(bool)

        rows = spread(self._records()).where(refused("payload")).distinct()
        return rows.select(F.col("file").alias(self.file_id), F.col("line").alias(self.line), F.col("payload").alias(self.payload))

    def unified(self) -> DataFrame:
        """(file_id, line_no, utt, fields...): one row per record that parses, numeric fields in seconds to the microsecond, others as text.

        A value that is absent, null, or no number where one is wanted is null. Exact duplicates of a line count once.
        """
        carriers = checkpointed(self.assigned().select(F.col("file").alias("_file"), "carriers"))
        rows = spread(self._records())
        placed = rows.join(broadcast_if_small(carriers), F.col("file") == F.col("_file"), "left").select("file", "line", "payload", "carriers")
        fields, key_path, line_type = self.fields, self.key_path, self.raw.select(col(self.line)).schema[0].dataType.simpleString()
        names = ["file", "line", "utt", *(f.name for f in fields)]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for file, line, payload, own in batch.itertuples(index=False, name=None):
                    value = parsed(_own(payload))
                    if value is None:
                        continue
                    held = dict(flat(value))
                    carrier = {c["field"]: c for c in own} if own is not None else {}
                    key = reading(held.get(key_path))
                    row = [file, _own(line), key and key[1]]
                    for f in fields:
                        c = carrier.get(f.name)
                        read = reading(held.get(c["path"])) if c else None
                        if read is None or f.numeric and read[2] is None:
                            row.append(None)
                        elif f.numeric:
                            row.append(round(read[2] if read[3] else read[2] * c["scale"], 6))
                        else:
                            row.append(read[1])
                    out.append(row)
                yield pd.DataFrame(out, columns=names).astype(object)

        kinds = ", ".join(f"`{f.name}` {'double' if f.numeric else 'string'}" for f in fields)
        table = placed.mapInPandas(run, f"file {self._type()}, line {line_type}, utt string, {kinds}").distinct()
        return table.withColumnRenamed("file", self.file_id).withColumnRenamed("line", self.line)
