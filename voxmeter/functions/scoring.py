"""Word and character errors of a hypothesis against a reference."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points that stand for words: a private alphabet, one letter for each word of a pair.
ALPHABET = "".join(map(chr, range(0x4E00, 0x4E00 + 4096)))


def words(text: Column) -> Column:
    """Words of a normalised text; none for null and empty ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _coded(own: Column, vocabulary: Column) -> Column:
    return F.array_join(F.transform(own, lambda w: F.substr(F.lit(ALPHABET), F.array_position(vocabulary, w).cast("int"), F.lit(1))), "")


def word_errors(ref: Column, hyp: Column) -> Column:
    """Least number of substituted, deleted and inserted words.

    Each distinct word of the pair becomes one code point, so the built-in edit distance of strings counts words. Pairs
    of more distinct words than the alphabet has go through a Python function that holds one row of the table.
    """
    r, h = words(ref), words(hyp)
    vocabulary = F.array_distinct(F.concat(r, h))
    # texts of so few letters fit whatever their words, which spares most pairs the second look at their vocabulary
    short = F.coalesce(F.length(ref), F.lit(0)) + F.coalesce(F.length(hyp), F.lit(0)) <= 2 * len(ALPHABET) - 2
    fits = short | (F.size(vocabulary) <= len(ALPHABET))

    @F.pandas_udf("long")
    def long_(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for refs, hyps in parts:
            yield pd.Series([None if a is None else least_edits(list(a), list(b)) for a, b in zip(refs, hyps)], dtype="Int64")

    return F.when(fits, F.levenshtein(_coded(r, vocabulary), _coded(h, vocabulary))).otherwise(long_(F.when(short, None).when(~fits, r), F.when(short, None).when(~fits, h))).cast("long")


def char_errors(ref: Column, hyp: Column) -> Column:
    """Edit distance in code points, spaces included."""
    return F.levenshtein(F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit(""))).cast("long")


def least_edits(ref: list, hyp: list) -> int:
    """Edit distance of two lists, as in align() but with one row of the table at a time."""
    codes: dict = {}
    a = [codes.setdefault(w, len(codes)) for w in ref]
    b = np.array([codes.setdefault(w, len(codes)) for w in hyp], np.int64)
    steps = np.arange(len(b) + 1, dtype=np.int64)
    row = steps
    for i, x in enumerate(a, 1):
        new = np.empty_like(steps)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (b != x), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def align(ref: list, hyp: list) -> tuple[int, int, int]:
    """(substitutions, deletions, insertions) of a least-cost alignment.

    Of several, the one found from the end that takes a match, else a substitution, a deletion, an insertion. Rows of
    the table are computed at once; insertions within a row are a running minimum.
    """
    n, m = len(ref), len(hyp)
    codes: dict = {}
    a = np.array([codes.setdefault(w, len(codes)) for w in ref], np.int64)
    b = np.array([codes.setdefault(w, len(codes)) for w in hyp], np.int64)
    table = np.empty((n + 1, m + 1), np.int32)
    steps = np.arange(m + 1, dtype=np.int32)
    table[0] = steps
    for i in range(1, n + 1):
        row = np.empty(m + 1, np.int32)
        row[0] = i
        row[1:] = np.minimum(table[i - 1, :-1] + (b != a[i - 1]), table[i - 1, 1:] + 1)
        table[i] = np.minimum.accumulate(row - steps) + steps
    subs = dels = ins = 0
    i, j = n, m
    while i or j:
        here = table[i, j]
        if i and j and a[i - 1] == b[j - 1] and table[i - 1, j - 1] == here:
            i, j = i - 1, j - 1
        elif i and j and table[i - 1, j - 1] + 1 == here:
            subs, i, j = subs + 1, i - 1, j - 1
        elif i and table[i - 1, j] + 1 == here:
            dels, i = dels + 1, i - 1
        else:
            ins, j = ins + 1, j - 1
    return subs, dels, ins


def alignment(ref: Column, hyp: Column) -> Column:
    """Struct (subs, dels, ins) of the words of two normalised texts; null where the reference is null."""

    @F.pandas_udf("subs long, dels long, ins long")
    def aligned(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for refs, hyps in parts:
            rows = [(None,) * 3 if r is None else align(r.split(), (h or "").split()) for r, h in zip(refs, hyps)]
            yield pd.DataFrame(rows, columns=["subs", "dels", "ins"]).astype("Int64")

    return aligned(ref, hyp)
