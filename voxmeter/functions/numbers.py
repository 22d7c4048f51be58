"""Cardinal numbers in words, for the languages of the benchmark that have them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The number words of each language.
EN_ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
EN_TENS = "- - twenty thirty forty fifty sixty seventy eighty ninety".split()
ES_ONES = (
    "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve "
    "veinte veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve"
).split()
ES_TENS = "- - veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa".split()
ES_HUNDREDS = "- ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos".split()
PT_ONES = "zero um dois três quatro cinco seis sete oito nove dez onze doze treze catorze quinze dezesseis dezessete dezoito dezenove".split()
PT_TENS = "- - vinte trinta quarenta cinquenta sessenta setenta oitenta noventa".split()
PT_HUNDREDS = "- cento duzentos trezentos quatrocentos quinhentos seiscentos setecentos oitocentos novecentos".split()
NL_ONES = "nul een twee drie vier vijf zes zeven acht negen tien elf twaalf dertien veertien vijftien zestien zeventien achttien negentien".split()
NL_TENS = "- - twintig dertig veertig vijftig zestig zeventig tachtig negentig".split()
POINT = {"en": "point", "es": "punto", "pt": "vírgula", "nl": "komma"}
#: Language of a benchmark locale's numbers; ky has none, its digits stay.
NUMBER_LANGUAGES = {"en-US": "en", "es-ES": "es", "es-MX": "es", "nl-NL": "nl", "pt-BR": "pt"}
GREATEST = 999_999_999
# Names of the powers of a thousand (en, pt) or of a million (es, nl) from the second on.
EN_SCALE = "million billion trillion quadrillion quintillion sextillion septillion octillion nonillion decillion".split()
ES_SCALE = "millón billón trillón cuatrillón".split()
PT_SCALE = "milhão bilhão trilhão quatrilhão quintilhão sextilhão septilhão octilhão nonilhão decilhão".split()
NL_SCALE = "miljoen miljard biljoen biljard triljoen triljard quadriljoen quadriljard quintiljoen quintiljard".split()
#: The first number of each language that stays digits.
BEYOND = {"en": 10**36, "es": 10**30, "pt": 10**36, "nl": 10**36}


def _unit(n: int, scale: list[str]) -> tuple[int, str]:
    """The greatest named power of a thousand up to n, from a million on."""
    k = (len(str(n)) - 1) // 3
    return 1000**k, scale[k - 2]


def _english(n: int) -> str:
    if n < 20:
        return EN_ONES[n]
    if n < 100:
        return EN_TENS[n // 10] + (f"-{EN_ONES[n % 10]}" if n % 10 else "")
    if n < 1000:
        return f"{EN_ONES[n // 100]} hundred" + (f" and {_english(n % 100)}" if n % 100 else "")
    unit, name = _unit(n, EN_SCALE) if n >= 1_000_000 else (1000, "thousand")
    rest = n % unit
    joint = " and " if 0 < rest < 100 else ", "
    return f"{_english(n // unit)} {name}" + (joint + _english(rest) if rest else "")


def _spanish(n: int) -> str:
    if n < 30:
        return ES_ONES[n]
    if n < 100:
        return ES_TENS[n // 10] + (f" y {ES_ONES[n % 10]}" if n % 10 else "")
    if n < 1000:
        return "cien" if n == 100 else ES_HUNDREDS[n // 100] + (f" {_spanish(n % 100)}" if n % 100 else "")
    if n < 1_000_000:
        head = "mil" if n < 2000 else re.sub(r"veintiuno$", "veintiún", re.sub(r"( |^)uno$", r"\1un", _spanish(n // 1000))) + " mil"
        unit = 1000
    else:
        k = (len(str(n)) - 1) // 6
        unit, name = 1_000_000**k, ES_SCALE[k - 1]
        times = re.sub(r"veintiuno$", "veintiún", re.sub(r"( |^)uno$", r"\1un", _spanish(n // unit)))
        head = f"un {name}" if n < 2 * unit else f"{times} {name[:-2]}ones"
    rest = n % unit
    return head + (f" {_spanish(rest)}" if rest else "")


def _portuguese(n: int) -> str:
    if n < 20:
        return PT_ONES[n]
    if n < 100:
        return PT_TENS[n // 10] + (f" e {PT_ONES[n % 10]}" if n % 10 else "")
    if n < 1000:
        return "cem" if n == 100 else PT_HUNDREDS[n // 100] + (f" e {_portuguese(n % 100)}" if n % 100 else "")
    if n < 1_000_000:
        unit = 1000
        head = "mil" if n < 2000 else f"{_portuguese(n // 1000)} mil"
    else:
        unit, name = _unit(n, PT_SCALE)
        head = f"um {name}" if n < 2 * unit else f"{_portuguese(n // unit)} {name[:-2]}ões"
    rest = n % unit
    joint = " e " if rest < 100 or rest % 100 == 0 and rest < 1000 else " "
    return head + (joint + _portuguese(rest) if rest else "")


def _dutch(n: int) -> str:
    if n < 20:
        return NL_ONES[n]
    if n < 100:
        one = NL_ONES[n % 10]
        return (one + ("ën" if one.endswith("e") else "en") if n % 10 else "") + NL_TENS[n // 10]
    if n < 1000:
        return ("" if n < 200 else NL_ONES[n // 100]) + "honderd" + (_dutch(n % 100) if n % 100 else "")
    if n < 1_000_000:
        return ("" if n < 2000 else _dutch(n // 1000)) + "duizend" + (_dutch(n % 1000) if n % 1000 else "")
    unit, name = _unit(n, NL_SCALE)
    return f"{_dutch(n // unit)} {name}" + (f" {_dutch(n % unit)}" if n % unit else "")


SPEAKERS: dict[str, Callable[[int], str]] = {"en": _english, "es": _spanish, "pt": _portuguese, "nl": _dutch}

# The three forms of numbers in texts.
GROUPED = re.compile(r"(?<!\d)\d{1,3}(?:[.,]\d{3})+(?!\d)")
DECIMAL = re.compile(r"(?<!\d)(\d+)[.,](\d+)(?!\d)")
WHOLE = re.compile(r"(?<!\d)\d+(?!\d)")


def say(n: int, language: str, greatest: int = GREATEST) -> str:
    """n in words; digits beyond the greatest number."""
    return SPEAKERS[language](n) if n <= greatest else str(n)


def say_any(n: int, language: str) -> str:
    """n in words as far as the language's scale goes."""
    return say(n, language, BEYOND[language] - 1)


def say_fraction(digits: str, language: str) -> str:
    """0.digits in words, digit by digit, without trailing zeros."""
    digits = digits.rstrip("0") or "0"
    return " ".join([say(0, language), POINT[language], *(say(int(d), language) for d in digits)])


def expand_digits(text: str, language: str | None) -> str:
    """Digits as words: grouped integers (1.500 is 1500), then decimals, then the other integers. No language: as it is."""
    if language is None:
        return text
    text = GROUPED.sub(lambda m: say_any(int(re.sub(r"[.,]", "", m[0])), language), text)
    text = DECIMAL.sub(lambda m: f"{say_any(int(m[1]), language)} {say_fraction(m[2], language)}", text)
    return WHOLE.sub(lambda m: say_any(int(m[0]), language), text)


def said(number: Column, language: str) -> Column:
    """A column of whole numbers in words; null for null."""

    @F.pandas_udf("string")
    def words(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if pd.isna(n) else say_any(int(n), language) for n in part], dtype=object)

    return words(number)
