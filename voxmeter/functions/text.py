"""Normal form of texts before scoring: Unicode form, apostrophes, case, digits, punctuation to spaces, white space.

Everything is a JVM expression but for two steps that no built-in function has, composing Unicode and saying numbers;
they share one Arrow function that is given only the rows that need it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import NUMBER_LANGUAGES, expand_digits

# Apostrophes that stand for the plain one, and the signs that become spaces.
TYPOGRAPHIC_APOSTROPHES = "’ʼ՚＇"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…–—¿¡"
FORMS = ("NFC", "NFD", "NFKC", "NFKD")
#: Characters that composed text may hold only by accident: marks, and blocks with singleton decompositions.
_MAY_COMPOSE = r"[\p{M}\x{340}-\x{387}\x{1100}-\x{11FF}\x{1F00}-\x{1FFF}\x{2000}\x{2001}\x{2126}-\x{212B}\x{2329}\x{232A}\x{F900}-\x{FAFF}\x{10000}-\x{10FFFF}]"


@dataclass(frozen=True)
class Normalization:
    form: str = "NFC"
    lowercase: bool = True
    expand_digits: bool = True
    skip_digit_languages: tuple[str, ...] = ("ky",)
    keep_apostrophes: bool = True
    fold_apostrophes: bool = False
    punctuation: str = PUNCTUATION

    def __post_init__(self):
        if self.form not in FORMS:
            raise ValueError(f"unknown Unicode form {self.form!r}")


def number_language(lang: str | None, options: Normalization) -> str | None:
    return None if lang in options.skip_digit_languages or not options.expand_digits else NUMBER_LANGUAGES.get(lang)


def _python_steps(text: Column, lang: Column, options: Normalization) -> Column:
    @F.pandas_udf("string")
    def steps(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, langs in parts:
            yield pd.Series(
                [None if t is None else expand_digits(unicodedata.normalize(options.form, t), number_language(x, options)) for t, x in zip(texts, langs)],
                dtype=object,
            )

    odd = text.rlike(_MAY_COMPOSE) if options.form == "NFC" else text.rlike(r"[^\x{0}-\x{7F}]")
    spoken = [x for x in NUMBER_LANGUAGES if number_language(x, options)]
    needs = odd | (text.rlike("[0-9]") & lang.isin(*spoken)) if spoken else odd
    return F.coalesce(steps(F.when(needs, text), lang), text)


def fold_apostrophes(text: Column) -> Column:
    return F.translate(text, TYPOGRAPHIC_APOSTROPHES, "'" * len(TYPOGRAPHIC_APOSTROPHES))


def strip_punctuation(text: Column, options: Normalization = Normalization()) -> Column:
    """Punctuation as spaces, not removed: it separates words. Plain apostrophes stay within words."""
    signs = options.punctuation if options.keep_apostrophes else options.punctuation + "'"
    return F.translate(text, signs, " " * len(signs))


def collapse(text: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize(text: Column, lang: Column, options: Normalization = Normalization()) -> Column:
    """The normal form of text; empty for null and empty texts."""
    out = _python_steps(text, lang, options)
    if options.fold_apostrophes:
        out = fold_apostrophes(out)
    if options.lowercase:
        out = F.lower(out)
    return F.coalesce(collapse(strip_punctuation(out, options)), F.lit(""))


def has_typographic_apostrophe(text: Column) -> Column:
    return F.coalesce(text.rlike(f"[{TYPOGRAPHIC_APOSTROPHES}]"), F.lit(False))


def diagnostics(text: Column, lang: Column, options: Normalization = Normalization()) -> dict[str, Column]:
    """Per text: apostrophes that folding changes, numbers said, digits left as they are."""
    text = F.coalesce(text, F.lit(""))
    folded = F.length(text) - F.length(F.translate(text, TYPOGRAPHIC_APOSTROPHES, ""))
    spoken = [x for x in NUMBER_LANGUAGES if number_language(x, options)]
    says = F.coalesce(lang.isin(*spoken), F.lit(False)) if spoken else F.lit(False)
    digits = F.regexp_count(text, F.lit("[0-9]"))
    # groups of three after a separator belong to the number before them; so does one fraction
    numbers = F.regexp_count(text, F.lit(r"(?<![0-9])(?:[0-9]{1,3}(?:[.,][0-9]{3})+|[0-9]+[.,][0-9]+|[0-9]+)(?![0-9])"))
    zero = F.lit(0)
    return {
        "apostrophes_folded": folded.cast("long") if options.fold_apostrophes else zero.cast("long"),
        "digits_expanded": F.when(says, numbers).otherwise(zero).cast("long"),
        "digits_left": F.when(says, zero).otherwise(digits).cast("long"),
    }
