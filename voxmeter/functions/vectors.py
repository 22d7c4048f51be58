"""Arithmetic on arrays: cosines, chunks, segments, decibels, masked pooling. All are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision, summed from the first element; the cosine of unit vectors."""
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """v scaled to length 1; null for a zero vector."""
    return F.transform(_doubles(v), lambda x: F.try_divide(x, norm(v)))


def combination(a: Column, b: Column, wa: float, wb: float) -> Column:
    return F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * F.lit(wa) + y * F.lit(wb))


def _starts(n: Column, width: Column, hop: Column) -> Column:
    """0, hop, 2 hop, ... while a window fits; none where the array is shorter than a window."""
    return F.when(n >= width, F.sequence(F.lit(0).cast("int"), (n - width).cast("int"), hop.cast("int"))).otherwise(F.array().cast("array<int>"))


def chunks(v: Column, width: Column, hop: Column, most: int | None = None) -> Column:
    """Windows of width elements every hop elements, at most so many."""
    starts = _starts(F.size(v), width, hop)
    starts = starts if most is None else F.slice(starts, 1, most)
    return F.transform(starts, lambda s: F.slice(v, s + 1, width))


def anchor_chunk_seconds(duration: Column, longest: float = 4.0, least: float = 2.0) -> Column:
    """Length of the chunks that a recording is cut into: half of it, at most longest; null if that is too short."""
    chunk = F.least(F.lit(longest), duration / 2)
    return F.when(chunk >= least, chunk)


def anchor_hop(duration: Column, chunk: Column, hop: float = 2.0) -> Column:
    """Step between chunks: no overlap where two whole chunks fit."""
    return F.when((F.lit(hop) < chunk) & (duration >= 2 * chunk), chunk).otherwise(F.lit(hop))


def segments(v: Column, length: int, hop: int = 1, most: int | None = None) -> Column:
    """Every hop-th window of an odd number of elements, padded with zeros to the greatest number of windows if given.

    An array shorter than a window, or of more windows than most, is an error of the caller: null.
    """
    if length % 2 == 0:
        raise ValueError("the length of a segment must be odd")
    n = F.size(v) - (length - 1)
    windows = chunks(v, F.lit(length), F.lit(hop))
    if most is None:
        return F.when(n >= 1, windows)
    empty = F.array_repeat(F.lit(0.0), length)
    return F.when((n >= 1) & (F.size(windows) <= most), F.concat(F.transform(windows, _doubles), F.array_repeat(empty, F.lit(most) - F.size(windows))))


def segment_count(n: Column, length: int, hop: int = 1) -> Column:
    return F.ceil((n - (length - 1)) / hop)


def power_to_db(v: Column, floor: float = 1e-10, top_db: float | None = 80.0) -> Column:
    """10 log10 of each power against the greatest, no lower than -top_db."""
    db = F.transform(_doubles(v), lambda x: F.lit(10.0) * F.log10(F.greatest(x, F.lit(floor))))
    top = F.array_max(db)
    if top_db is None:
        return F.transform(db, lambda x: x - top)
    return F.transform(db, lambda x: F.greatest(x - top, F.lit(-top_db)))


def scaled_db(v: Column, reference: float = 80.0) -> Column:
    """power_to_db() shifted and scaled to 0..1."""
    return F.transform(power_to_db(v, top_db=None), lambda d: (d + F.lit(reference)) / F.lit(reference))


def padded(v: Column, length: int) -> Column:
    """v cut or padded with zeros to a length."""
    return F.slice(F.concat(_doubles(v), F.array_repeat(F.lit(0.0), length)), 1, length)


def masked_mean(v: Column, valid: Column) -> Column:
    """Mean of the first valid elements; null without any."""
    head = F.slice(_doubles(v), 1, valid)
    return F.try_divide(F.aggregate(head, F.lit(0.0), lambda s, x: s + x), F.size(head))


def masked_max(v: Column, valid: Column) -> Column:
    return F.array_max(F.slice(_doubles(v), 1, valid))


def masked_softmax_mean(v: Column, scores: Column, valid: Column) -> Column:
    """Mean of the first valid elements weighted by the softmax of their scores."""
    head, own = F.slice(_doubles(v), 1, valid), F.slice(_doubles(scores), 1, valid)
    top = F.array_max(own)
    weights = F.transform(own, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(dot(head, weights), total)
