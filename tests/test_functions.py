import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxmeter.functions import audio, numbers, scoring, text, vectors
from voxmeter.operators import stats


def test_numbers_in_words():
    want = {
        "en": {0: "zero", 15: "fifteen", 42: "forty-two", 100: "one hundred", 215: "two hundred and fifteen", 1001: "one thousand and one", 1500: "one thousand, five hundred"},
        "es": {21: "veintiuno", 42: "cuarenta y dos", 100: "cien", 101: "ciento uno", 1000: "mil", 21000: "veintiún mil", 1500: "mil quinientos", 2_000_000: "dos millones"},
        "pt": {16: "dezesseis", 42: "quarenta e dois", 100: "cem", 101: "cento e um", 1001: "mil e um", 1500: "mil e quinhentos", 1501: "mil quinhentos e um"},
        "nl": {12: "twaalf", 22: "tweeëntwintig", 41: "eenenveertig", 100: "honderd", 215: "tweehonderdvijftien", 1500: "duizendvijfhonderd"},
    }
    for lang, cases in want.items():
        for n, words in cases.items():
            assert numbers.say(n, lang) == words
    assert numbers.say(10**12, "en") == str(10**12)


def test_digits_in_context():
    assert numbers.expand_digits("1.500 or 1,500", "en") == "one thousand, five hundred or one thousand, five hundred"
    assert numbers.expand_digits("3.5", "nl") == "drie nul komma vijf"
    assert numbers.expand_digits("7, 8", "es") == "siete, ocho" and numbers.expand_digits("7", None) == "7"


def normalized(spark, rows, options=text.Normalization()):
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "i long, t string, lang string")
    return [r["n"] for r in df.select("i", text.normalize(F.col("t"), F.col("lang"), options).alias("n")).orderBy("i").collect()]


def test_long_digits_in_context():
    """Numbers past a thousand million are said, too, to the end of each scale."""
    n = "00012345678901234567890"
    assert numbers.expand_digits(n, "en") == (
        "twelve quintillion, three hundred and forty-five quadrillion, six hundred and seventy-eight trillion, nine hundred and one billion, "
        "two hundred and thirty-four million, five hundred and sixty-seven thousand, eight hundred and ninety"
    )
    assert numbers.expand_digits("1000000000 21000000", "es") == "mil millones veintiún millones"
    assert numbers.expand_digits("2000000000001", "es") == "dos billones uno" and numbers.expand_digits("31000000", "es") == "treinta y un millones"
    assert numbers.expand_digits("2.000.000.000", "pt") == "dois bilhões" and numbers.expand_digits("1000000000001", "pt") == "um trilhão e um"
    assert numbers.expand_digits("2000000000", "nl") == "twee miljard" and numbers.expand_digits("1000000000000", "nl") == "een biljoen"
    for lang, beyond in numbers.BEYOND.items():
        assert beyond > 10**24 and not any(c.isdigit() for c in numbers.expand_digits(str(beyond - 1), lang))
        assert numbers.expand_digits(f"0{beyond}", lang) == str(beyond)


def test_normalize(spark):
    rows = [
        ("It’s  CLEAR: don't-stop…", "en-US"), (None, "en-US"), ("", "ky"), ("  ", "ky"), ("Año  é 12 m²", "es-ES"), ("12 жазуу", "ky"),
        ("ʼ ՚ ＇", "en-US"), ("20", None),
    ]
    assert normalized(spark, rows) == ["it s clear don't stop", "", "", "", "año é doce m²", "12 жазуу", "ʼ ՚ ＇", "20"]
    assert normalized(spark, rows[:1], text.Normalization(fold_apostrophes=True)) == ["it's clear don't stop"]
    assert normalized(spark, [("don't 5", "en-US")], text.Normalization(keep_apostrophes=False, expand_digits=False)) == ["don t 5"]
    with pytest.raises(ValueError):
        text.Normalization(form="NFX")


def test_composes_like_python(spark):
    rows = [(unicodedata.normalize("NFD", t), "ky") for t in ("ñandú", "йод", "한글", "Å", "ệ", "Ά")]
    assert normalized(spark, rows) == [unicodedata.normalize("NFC", t).lower() for t, _ in rows]


def edits(a, b):
    table = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, table[0] = table[0], i
        for j, y in enumerate(b, 1):
            last, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, last + (x != y))
    return table[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=9), st.lists(st.sampled_from("abcd"), max_size=9))
def test_alignment(a, b):
    s, d, i = scoring.align(a, b)
    assert s + d + i == edits(a, b) and d - i == len(a) - len(b)


def test_word_errors(spark):
    rng = random.Random(4)
    words = ["año", "ano", "中文字", "x", "’", "word"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(60)]
    rows += [(None, "x"), ("x", None), ("", ""), (" ".join(f"w{i}" for i in range(5000)), "w1 w2")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, r string, h string")
    got = {x["i"]: x for x in df.select("i", scoring.word_errors(F.col("r"), F.col("h")).alias("w"), scoring.char_errors(F.col("r"), F.col("h")).alias("c"), scoring.alignment(F.col("r"), F.col("h")).alias("a")).collect()}
    for i, (r, h) in enumerate(rows):
        assert got[i]["w"] == edits((r or "").split(), (h or "").split())
        if i < 63:
            assert got[i]["c"] == edits(r or "", h or "")
    assert got[60]["a"]["subs"] is None and got[63]["a"]["dels"] == 4998


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0, 1.0, 2.0], 2), ([], 0), (None, 1)], "v array<double>, n int")
    v, n = F.col("v"), F.col("n")
    out = df.select(
        vectors.dot(v, v).alias("dot"), vectors.chunks(v, F.lit(2), F.lit(2)).alias("chunks"), vectors.segments(v, 3, 1, 4).alias("padded"),
        vectors.segments(v, 3, 2).alias("plain"), vectors.masked_mean(v, n).alias("mean"), vectors.masked_max(v, n).alias("top"),
        vectors.masked_softmax_mean(v, v, n).alias("soft"), vectors.power_to_db(v).alias("db"), vectors.padded(v, 6).alias("six"),
    ).collect()
    a, b, c = out
    assert a["dot"] == 30 and a["chunks"] == [[3.0, 4.0], [0.0, 1.0]] and b["chunks"] == [] and b["plain"] is None and c["dot"] is None
    assert a["padded"] == [[3.0, 4.0, 0.0], [4.0, 0.0, 1.0], [0.0, 1.0, 2.0], [0.0, 0.0, 0.0]] and a["plain"] == [[3.0, 4.0, 0.0], [0.0, 1.0, 2.0]]
    assert a["mean"] == 3.5 and a["top"] == 4 and abs(a["soft"] - (3 + 4 * np.e) / (1 + np.e)) < 1e-12 and b["mean"] is None
    assert max(a["db"]) == 0 and min(a["db"]) == -80 and a["six"] == [3.0, 4.0, 0.0, 1.0, 2.0, 0.0]
    with pytest.raises(ValueError):
        vectors.segments(v, 4)


def test_draws_are_even():
    """The draws' hash spreads replicates and draws over clusters like chance does."""
    def h(rep, draw):
        x = (stats.SEED + (rep + 1) * stats.STEP_REP % stats.MODULUS + (draw + 1) * stats.STEP_DRAW % stats.MODULUS) % stats.MODULUS
        for _ in range(2):
            x = (x * x % stats.MODULUS * stats.MIX + stats.ADD) % stats.MODULUS
        return x

    for k in (7, 20, 97):
        counts = np.bincount([h(r, d) % k for r in range(500) for d in range(k)], minlength=k)
        assert ((counts - 500) ** 2 / 500).sum() < 2 * k + 20
        per_rep = np.array([[h(r, d) % k for d in range(k)] for r in range(500)])
        assert 0.55 < np.mean([len(set(x)) / k for x in per_rep]) < 0.72


def test_audio(spark):
    import io
    import wave

    def wav(x, channels=1):
        b = io.BytesIO()
        with wave.open(b, "wb") as f:
            f.setnchannels(channels)
            f.setsampwidth(2)
            f.setframerate(16000)
            f.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())
        return b.getvalue()

    tone = np.sin(np.arange(1600) * 0.2) * 0.5
    rows = [(1, (wav(tone), None)), (2, (b"junk", None)), (3, (None, None)), (4, (wav(np.repeat(tone, 2), 2), "x"))]
    df = spark.createDataFrame(rows, "i int, a struct<bytes: binary, path: string>")
    got = {r["i"]: r["d"] for r in df.select("i", audio.decoded(F.col("a")).alias("d")).collect()}
    assert got[1]["rate"] == 16000 and np.allclose(got[1]["samples"], tone, atol=1e-3) and np.allclose(got[4]["samples"], tone, atol=1e-3)
    assert got[2]["samples"] is None and got[2]["error"] and "ValueError" in got[3]["error"]
    mel = audio.mel_spectrogram(tone.astype(np.float32), 16000, fmax=8000)
    assert mel.shape == (32, 21) and mel.max() - mel.min() <= 80
    assert len(audio.resampled(tone, 16000, 48000)) == 4800
