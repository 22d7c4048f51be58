"""Language labels of documents, and of the parts of documents that mix languages.

A language's profile is the ranking of the most frequent character n-grams of its words. A piece of text is compared by
the out-of-place distance: its own n-grams are ranked by frequency, and the differences from the ranks in the profile
are summed, an absent n-gram counting as the last rank. Documents are cut into sentences and these at commas, colons,
quotes and dashes into clauses; each clause with enough words takes the language of least distance, short or undecided
ones follow their sentence. Runs of one language are its segments.

Profiles are fitted on a bounded sample of labelled documents; a few wrong labels don't move the ranks of a profile.
Labelling is a row-wise map with the profiles (languages x size n-grams) in the closure: no shuffle, whole texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import col

LANGUAGES = ("en", "es", "pt", "nl", "ky")
#: N-grams of a profile, their greatest length, and labelled documents a language that a profile is fitted on.
PROFILE, LONGEST, SAMPLE = 3000, 4, 2_000
#: Words that a sentence or clause must have in a language for the text to be written in it.
EVIDENCE = 6
#: A clause decides for itself from so many words, letters and this lead of the best language.
OWN_WORDS, OWN_LETTERS, LEAD = 3, 12, 0.04
#: Characters of text that a worker handles at once.
PART = 50_000
#: Words whose n-grams a worker remembers.
MEMO = 200_000

# a run of bare words, or one token, or the end of a line
_TOKEN = re.compile(r"([^\W\d_]++(?: ++[^\W\d_]++(?!\S))+)|\S+|\n")
_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_OPENS = re.compile(r"[(\[{“„«\"‹]|^[–—\-/|→]+$")
_CLOSES = re.compile(r"[,;:)\]}”»\"›]|^[–—\-/|→]+$")
_ENDS = re.compile(r"[.!?…]")


def _bare(word: str) -> str:
    """A word in lower case, composed, without invisible characters."""
    if word.isascii() or word.isalpha() and unicodedata.is_normalized("NFC", word):
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFC", word).lower() if unicodedata.category(c) != "Cf")


def _is_word(word: str) -> bool:
    return word.isalpha() or bool(word) and all(c.isalpha() or c in "'’-" for c in word)


class _Token(NamedTuple):
    """What a token of letters and signs says: its word, the signs before and after it, and what they open and close."""

    low: str
    is_word: bool
    counts: bool
    core: bool
    lead: int
    tail: int
    initial: bool
    lower_start: bool
    opens: bool
    ends: bool
    closes: bool


def _token(token: str) -> _Token:
    core = _CORE.search(token)
    word = core[0] if core else ""
    before, after = (token[: core.start()], token[core.end() :]) if core else (token, token)
    low = _bare(word)
    is_word = _is_word(low)
    number = word.isdigit() and len(word) <= 4 and token.strip(".,;:!?…()“”«»\"") == word
    return _Token(
        low, is_word, is_word or number, core is not None, len(before), len(after), is_word and len(word) == 1 and after.startswith(":"),
        word[:1].islower(), bool(_OPENS.search(before)), bool(_ENDS.search(after)), bool(_CLOSES.search(after)),
    )


_seen = lru_cache(MEMO)(_token)


def _edits(a: str, b: str) -> int:
    """Letters to insert, delete, replace or swap with their neighbour to get from a to b."""
    older: list[int] = []
    old = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                least = min(least, older[j - 2] + 1)
            row.append(least)
        older, old = old, row
    return old[-1]


@lru_cache(MEMO)
def _slip(a: str, b: str) -> bool:
    """Whether two different words may be one, mistyped: one slip apart, two from eight letters on."""
    n, m = len(a), len(b)
    slips = 1 if max(n, m) < 8 else 2
    if min(n, m) < 4 or max(n, m) < 5 or a[0] != b[0] and a[-1] != b[-1] or abs(n - m) > slips or len(set(a) ^ set(b)) > 2 * slips:
        return False
    return _edits(a, b) <= slips


def _tokens(text: str) -> Iterator[tuple[int, str, bool]]:
    """(start, token, bare): ends of lines, runs of bare words and single tokens; bare: letters alone."""
    for m in _TOKEN.finditer(text):
        token = m[0]
        if m.lastindex and not token.replace(" ", "").isalpha():
            # fractions and the like pass for letters in a pattern
            yield from ((m.start() + x.start(), x[0], x[0].isalpha()) for x in re.finditer(r"\S+", token))
        else:
            yield m.start(), token, m.lastindex is not None or token.isalpha()


@dataclass
class Clause:
    start: int
    end: int
    sentence: int
    words: list[str] = field(default_factory=list)
    counted: int = 0


class _Run:
    """One word over and over: the same twice in a row, or three in a row that are a slip apart, long ones two.

    Two different words are two words, however near, as long as no third one follows.
    """

    __slots__ = ("name", "last", "tokens", "extra")

    def __init__(self) -> None:
        self.name = self.last = ""
        self.tokens = self.extra = 0

    def add_all(self, clause: Clause, words: list[str]) -> None:
        """Counts words of the clause; at once, where none of them can be part of a run."""
        if self.tokens < 2:
            last = self.last
            for word in words:
                if word == last or last and _slip(last, word):
                    break
                last = word
            else:
                self.name = self.last = last
                self.tokens, self.extra = 1, 0
                clause.counted += len(words)
                clause.words += words
                return
        for word in words:
            self.add(clause, word)

    def add(self, clause: Clause, word: str, is_word: bool = True) -> None:
        """Counts a word of the clause unless it continues a run."""
        if word != self.last and not (self.tokens and (_slip(self.last, word) or self.name is not self.last and (word == self.name or _slip(self.name, word)))):
            self.name, self.tokens, self.extra = word, 1, 0
        elif word == self.last or self.tokens > 1:
            self.tokens += 1
            if self.extra:
                # the second word was counted before this was known to be a run
                clause.counted -= 1
                clause.words.pop()
                self.extra = 0
            if word == self.last:
                # what is written twice is the word, the first one may be mistyped
                self.name = word
            self.last = word
            return
        else:
            self.tokens, self.extra = 2, 1
        self.last = word
        clause.counted += 1
        if is_word:
            clause.words.append(word)


def clauses(text: str) -> list[Clause]:
    """Clauses in order, with offsets in text, the words that count for the profile, and all that count as words.

    Tokens with digits among other signs are codes and no words; a plain number counts but says nothing. A word's
    immediate repetitions count once, with the mistyped ones in a run of it. A single letter before a colon at a line's start is a speaker.
    """
    out: list[Clause] = []
    run = _Run()
    sentence, fresh, ended, line_start = 0, True, True, True
    for start, token, bare in _tokens(text):
        if token == "\n":
            line_start = True
            continue
        if bare and (not line_start or " " in token):
            # the common case
            if line_start:
                line_start = False
                if ended or not token[0].islower():
                    sentence, fresh = sentence + 1, True
            end = start + len(token)
            if fresh or not out:
                out.append(Clause(start, end, sentence))
                fresh, run = False, _Run()
            clause = out[-1]
            clause.end = end
            plain = token.isascii() or unicodedata.is_normalized("NFC", token)
            run.add_all(clause, token.lower().split() if plain else [_bare(w) for w in token.split()])
            ended = False
            continue
        t = _seen(token) if len(token) <= 40 else _token(token)
        if line_start and (ended or not t.lower_start):
            sentence, fresh = sentence + 1, True
        speaker = line_start and t.initial
        line_start = False
        if t.opens:
            fresh = True
        if t.counts and not speaker:
            if fresh or not out:
                out.append(Clause(start + t.lead, start + len(token), sentence))
                fresh, run = False, _Run()
            clause = out[-1]
            clause.end = start + len(token) - t.tail
            run.add(clause, t.low, t.is_word)
        if t.core:
            ended = t.ends
            if t.ends:
                sentence, fresh = sentence + 1, True
        if t.closes:
            fresh = True
    return out


def folded(word: str) -> str:
    """A word without accents."""
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def grams(word: str, longest: int = LONGEST) -> list[str]:
    w = f"_{word}_"
    return [w[i : i + n] for n in range(1, longest + 1) for i in range(len(w) - n + 1) if w[i : i + n] != "_"]


def named_language(label: Column, languages: Sequence[str] = LANGUAGES) -> Column:
    """The language that a label names, or null: its code in any mix of cases, alone or before - or _ and a region."""
    code = F.lower(F.regexp_extract(label, r"^([A-Za-z]{2})(?:[-_].*)?$", 1))
    return F.when(code.isin(*languages), code)


def _by_frequency(piece: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Order by piece, then falling frequency, then as they come; one sort of numbers that hold all three, where they fit."""
    if len(piece) < 1 << 21 and (not len(piece) or piece[-1] < 1 << 21):
        rest = (1 << 21) - 1 - np.minimum(times, (1 << 21) - 1)
        return np.sort(piece << 42 | rest << 21 | np.arange(len(piece))) & ((1 << 21) - 1)
    return np.lexsort((np.arange(len(piece)), -times, piece))


class Profiles:
    """Rank-order profiles of several languages."""

    def __init__(self, ranked: dict[str, list[str]], size: int = PROFILE, longest: int = LONGEST):
        self.languages, self.size, self.longest = list(ranked), size, longest
        self.index: dict[str, int] = {}
        for entries in ranked.values():
            for g in entries:
                self.index.setdefault(g, len(self.index))
        # the rank of each n-gram in each profile, the last one where a profile hasn't it
        self.places = np.full((len(self.index), len(ranked)), size, np.int16 if size < 10_000 else np.int32)
        for i, entries in enumerate(ranked.values()):
            self.places[[self.index[g] for g in entries], i] = np.arange(len(entries))
        self._forget()

    def _forget(self) -> None:
        # the n-grams of the words seen, one after the other, and where those of each word are
        self.words: dict[str, int] = {}
        self.grams, self.used = np.empty(1 << 16, np.int32), 0
        self.first, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)

    def _learn(self, word: str) -> int:
        """The number of a word that is seen for the first time."""
        ids = [self.index[g] for g in grams(word, self.longest) if g in self.index]
        n = len(self.words)
        if n == len(self.first):
            self.first, self.count = np.resize(self.first, 2 * n), np.resize(self.count, 2 * n)
        while self.used + len(ids) > len(self.grams):
            self.grams = np.resize(self.grams, 2 * len(self.grams))
        self.grams[self.used : self.used + len(ids)] = ids
        self.first[n], self.count[n] = self.used, len(ids)
        self.used += len(ids)
        self.words[word] = n
        return n

    def distances(self, pieces: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distance of each piece (a list of words) to each language, in 0..1, and its n-grams.

        N-grams that no profile has count the same for all languages and are left out before the others are ranked, so a
        piece's ranks are those among known n-grams; a piece without any has distance 1.
        """
        n, width = len(pieces), max(1, len(self.index))
        if len(self.words) > MEMO:
            self._forget()
        known, learn = self.words.get, self._learn
        ids = np.array([k if (k := known(w)) is not None else learn(w) for piece in pieces for w in piece], np.int64)
        each = self.count[ids]
        total_ = int(each.sum())
        # the n-grams of all words, in order, by their places
        at = np.repeat(self.first[ids] - np.concatenate(([0], np.cumsum(each)[:-1])), each) + np.arange(total_) if total_ else np.empty(0, np.int64)
        kind = np.int32 if n * width < 1 << 31 else np.int64
        owner = np.repeat(np.repeat(np.arange(n, dtype=kind) * kind(width), [len(piece) for piece in pieces]), each)
        key, times = np.unique(owner + self.grams[at], return_counts=True)
        piece = key // width
        gram = key - piece * width
        # ranks by falling frequency, then n-gram. Those that occur once, nearly all, are in order already and come last
        once = times == 1
        more = np.flatnonzero(~once)
        many = np.bincount(piece[more], minlength=n)
        first = np.searchsorted(piece, np.arange(n))
        singles = np.concatenate(([0], np.cumsum(once)))
        rank = singles[:-1] - singles[first][piece] + many[piece]
        order = more[_by_frequency(piece[more].astype(np.int64), times[more])]
        rank[order] = np.arange(len(order)) - np.concatenate(([0], np.cumsum(many)[:-1]))[piece[order]]
        held = np.diff(np.append(first, len(piece)))
        out = np.ones((n, len(self.languages)))
        full = np.flatnonzero(held)
        if len(full):
            # from twice the size on a rank is out of place by the size or more in every profile
            apart = self.places[gram]
            apart -= np.minimum(rank, 2 * self.size).astype(apart.dtype)[:, None]
            np.abs(apart, out=apart)
            total = np.add.reduceat(np.minimum(apart, self.size, out=apart), first[full], axis=0, dtype=np.int64)
            out[full] = total / held[full, None] / self.size
        return out, held


def fit_profiles(df: DataFrame, id_col: str, text_col: str, lang_col: str, languages: Sequence[str] = LANGUAGES, sample: int = SAMPLE, size: int = PROFILE, longest: int = LONGEST) -> Profiles:
    """Profiles from about sample documents of each label, chosen by a hash of the id; all of them if there are fewer.

    Only the profiles, languages x size n-grams, come to the driver. A language without labelled text has an empty
    profile and is never assigned.
    """
    labelled = df.select(col(id_col).alias("_id"), col(text_col).alias("_text"), named_language(col(lang_col), languages).alias("_lang"))
    labelled = labelled.where("_lang IS NOT NULL AND _text IS NOT NULL")
    counts = {r["_lang"]: r["n"] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("_lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    chosen = labelled.where(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}

        def close() -> pd.DataFrame:
            rows = []
            for lang, own in words.items():
                total: Counter = Counter()
                for w, n in own.items():
                    # each word once more without accents, as some writers leave them out
                    for g in grams(w, longest) + grams(folded(w), longest):
                        total[g] += n
                rows += [(lang, g, n) for g, n in total.items()]
            words.clear()
            return pd.DataFrame(rows, columns=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"]):
                words.setdefault(lang, Counter()).update(w for c in clauses(text) for w in c.words)
            if sum(map(len, words.values())) > MEMO:
                yield close()
        yield close()

    total = chosen.select("_lang", "_text").mapInPandas(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size)
    ranked: dict[str, list[str]] = {lang: [] for lang in languages}
    for r in top.orderBy("lang", "rank").collect():
        ranked[r["lang"]].append(r["gram"])
    return Profiles(ranked, size, longest)


def decided(distances: np.ndarray) -> list[int]:
    """The language that each clause's distances decide for, -1 where none leads by enough."""
    if not len(distances):
        return []
    ordered = np.sort(distances, axis=1)
    lead = ordered[:, 1] - ordered[:, 0] if distances.shape[1] > 1 else 1 - ordered[:, 0]
    return np.where(lead >= LEAD, distances.argmin(1), -1).tolist()


def assigned(found: list[Clause], best: list[int], distances: np.ndarray, grams_: np.ndarray) -> list[int]:
    """The language of each clause, -1 where nothing can be said: its own, or that of its sentence, or of a neighbour."""
    out = [k if k >= 0 and len(c.words) >= OWN_WORDS and len("".join(c.words)) >= OWN_LETTERS else -1 for c, k in zip(found, best)]
    if out and min(out) == max(out) >= 0:
        return out
    own = [k >= 0 for k in out]
    words: Counter = Counter()
    for i, c in enumerate(found):
        if own[i]:
            words[out[i]] += len(c.words)
    main = max(words, key=lambda k: (words[k], -k), default=-1)
    start = 0
    while start < len(found):
        end = start
        while end < len(found) and found[end].sentence == found[start].sentence:
            end += 1
        if not any(own[start:end]):
            # an undecided sentence is compared as a whole
            weight = grams_[start:end]
            if weight.sum() and sum(len(c.words) for c in found[start:end]) >= OWN_WORDS:
                whole = (distances[start:end] * weight[:, None]).sum(0) / weight.sum()
                # the text's main language keeps what is as good as its own
                close = main >= 0 and whole[main] - whole.min() < LEAD
                out[start:end] = [main if close else int(whole.argmin())] * (end - start)
        else:
            for i in range(start, end):
                if not own[i]:
                    out[i] = out[next(j for d in range(1, end - start) for j in (i - d, i + d) if start <= j < end and own[j])]
        start = end
    if max(out, default=0) < 0 and grams_.sum():
        # a text of short scraps only still has a likely language
        out = [int((distances * grams_[:, None]).sum(0).argmin())] * len(out)
    return out


def _segments(text: str, found: list[Clause], languages: list[int], distances: np.ndarray, grams_: np.ndarray) -> list[tuple]:
    """(start, end, language, confidence, words, evidence) of each run of clauses of one language.

    evidence: the most words that one sentence has in the run. confidence: by how much the best language beats the
    second, as a share of the second's distance, over the whole run.
    """
    runs: list[list[int]] = []
    for i, lang in enumerate(languages):
        if lang < 0:
            continue
        if runs and languages[runs[-1][-1]] == lang:
            runs[-1].append(i)
        else:
            runs.append([i])
    out = []
    for run in runs:
        per: Counter = Counter()
        for i in run:
            per[found[i].sentence] += found[i].counted
        whole = (distances[run] * grams_[run][:, None]).sum(0)
        lang = languages[run[0]]
        rest = np.delete(whole, lang)
        second = rest.min() if len(rest) else whole[lang]
        confidence = max(0.0, float((second - whole[lang]) / second)) if second > 0 else 0.0
        out.append((found[run[0]].start, found[run[-1]].end, lang, confidence, sum(found[i].counted for i in run), max(per.values())))
    return out


def _parts(texts: Sequence[str | None], chars: int = PART) -> Iterator[tuple[int, int]]:
    """(from, to) of parts of whole texts with about so many characters, which bounds a worker's memory."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 1
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_SEGMENTS = "segments array<struct<start:int,end:int,lang:string,confidence:double,words:int,evidence:int>>"


def language_segments(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str], profiles: Profiles) -> DataFrame:
    """(id, keep..., segments): the segments of every row's text, in order; none for null, empty and wordless texts.

    Offsets count code points. Nothing is shuffled; repeated rows stay.
    """
    names = [id_col, *keep]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*(col(c) for c in names)).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, rows = batch["_text"].tolist(), []
            for start, end in _parts(texts):
                cut = [clauses(t) if t else [] for t in texts[start:end]]
                distances, held = profiles.distances([c.words for found in cut for c in found])
                best, at = decided(distances), 0
                for text, found in zip(texts[start:end], cut):
                    d, g, b = (x[at : at + len(found)] for x in (distances, held, best))
                    at += len(found)
                    languages = assigned(found, b, d, g) if found else []
                    rows.append([(s, e, profiles.languages[k], c, w, v) for s, e, k, c, w, v in _segments(text, found, languages, d, g)])
            out = batch.drop(columns="_text")
            out["segments"] = pd.Series(rows, index=out.index, dtype=object)
            yield out

    return df.select(*(col(c) for c in names), col(text_col).alias("_text")).mapInPandas(run, f"{types}, {_SEGMENTS}")


def written_in(segments: Column, evidence: int = EVIDENCE) -> Column:
    """Languages, in order and once each, of which a segment has a sentence or clause of enough words."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(segments, lambda s: s["evidence"] >= evidence), lambda s: s["lang"])))


def document_languages(segmented: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """(id, label, lang, confidence, languages): the language of most words with its confidence, and all it's written in.

    confidence is the mean of the language's segments, weighted by words, times their share of all words. lang is null
    for documents without words.
    """
    by = F.transform(
        F.array_distinct(F.transform("segments", lambda s: s["lang"])),
        lambda lang: F.struct(
            F.aggregate(F.filter("segments", lambda s: s["lang"] == lang), F.lit(0), lambda a, s: a + s["words"]).alias("words"),
            F.aggregate(F.filter("segments", lambda s: s["lang"] == lang), F.lit(0.0), lambda a, s: a + s["words"] * s["confidence"]).alias("sure"),
            lang.alias("lang"),
        ),
    )
    total = F.aggregate("segments", F.lit(0), lambda a, s: a + s["words"])
    return segmented.select(col(id_col), col(lang_col).alias("label"), "segments", F.array_max(by).alias("_top"), total.alias("_total")).select(
        col(id_col), "label", F.col("_top.lang").alias("lang"), F.try_divide("_top.sure", "_total").alias("confidence"), written_in(F.col("segments")).alias("languages")
    )


def unnamed_languages(segmented: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """(id, lang): each language that a document is written in and its label doesn't name; one row per id and language."""
    named = named_language(col(lang_col))
    rows = segmented.select(col(id_col), named.alias("_named"), F.explode(written_in(F.col("segments"))).alias("lang"))
    return rows.where("_named IS NULL OR _named <> lang").select(col(id_col), "lang")
