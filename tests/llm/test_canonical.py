import unicodedata

import pytest

pytest.importorskip("voxmeter.llm")

from voxmeter.llm import canonical as c  # noqa: E402

SCHEMA = "row_id long, text string, lang string, ch string, _id int"

CASES = [
    # text, lang, canonical
    ("plain text, “quoted” – it’s 12 m² (3.º)…  twice ", "en-US", None),
    ("ｆｕｌｌ　ｗｉｄｔｈ！", "en-US", "full width!"),
    ("ﬁrst ﬂoor oﬃce", "en-US", "first floor office"),
    ("n​o­t ﻿here⁠", "en-US", "not here"),
    ("a b c d　e", "en-US", "a b c d e"),
    ("café ñ", "es-MX", "café ñ"),
    ("thе саt", "en-US", "the cat"),
    ("Тһе ɡarden", "en-US", "The garden"),
    ("word «жылдыз» and «көпүрө»", "en-US", None),
    ("жылдыз acсо ɵ", "ky", "жылдыз ассо ө"),
    ("Velbin айтты", "ky", None),
    ("й й", "ky", "й й"),
    ("Velбin", "ky", None),  # a misheard name: not every foreign letter looks like one of the row's script
    ("бoлут", "en-US", None),
    ("x̣̂ ộ", "en-US", unicodedata.normalize("NFC", "x̣̂ ộ")),
    ("́alone ͏", "en-US", "́alone "),
    ("😀 a‍😀", "en-US", "😀 a😀"),
    ("", "en-US", None),
    (None, "en-US", None),
    ("thе", None, "the"),
]


def rows(spark, cases):
    return spark.createDataFrame([(i, t, lang, "x", 7) for i, (t, lang, _) in enumerate(cases)], SCHEMA)


def test_cases(spark):
    df = rows(spark, CASES)
    got = {r["row_id"]: r["canonical"] for r in c.lookalike_rows([("t", df, "row_id", "text", "lang")]).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(CASES) if want is not None}


def test_all_rows_keep_their_number(spark):
    df = rows(spark, CASES)
    df = df.unionByName(df)
    out = c.canonical_texts(df, "row_id", "text", "lang").collect()
    assert len(out) == 2 * len(CASES)
    for r in out:
        want = CASES[r["row_id"]][2]
        assert r["canonical"] == (r["text"] if want is None else want)


def test_repeated_and_conflicting_rows(spark):
    df = spark.createDataFrame([(1, "а b", "en", "", 0), (1, "а b", "en", "", 0), (1, "с d", "en", "", 0)], SCHEMA)
    got = sorted((r["row_id"], r["canonical"]) for r in c.lookalike_rows([("t", df, "row_id", "text", "lang")]).collect())
    assert got == [(1, "a b"), (1, "c d")]


def test_long_text(spark):
    text = "ordinary café " * 20_000
    df = spark.createDataFrame([(1, text, "en", "", 0)], SCHEMA)
    assert c.lookalike_rows([("t", df, "row_id", "text", "lang")]).first()["canonical"] == unicodedata.normalize("NFC", text)


def forms(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "", 0) for i, t in enumerate(texts)], SCHEMA)
    return {r["row_id"]: r["canonical"] for r in c.canonical_texts(df, "row_id", "text", "lang").collect()}


def test_composition_agrees_with_unicode(spark):
    """Whatever decomposes or begins a pair, followed by one and two marks, comes out as NFC has it."""
    starters = {p[0] for p in c.compositions()} | set(c.compositions().values())
    starters |= {chr(p) for p in range(32, 0x110000) if unicodedata.decomposition(chr(p))[:1] not in ("", "<")}
    starters = sorted(x for x in starters if unicodedata.normalize("NFC", c._plain(x)) == unicodedata.normalize("NFC", x))
    marks = sorted({p[1] for p in c.compositions()})
    few = "\u0323\u0301\u0302\u0345\u3099\u0338\u05b4"
    # the first letter looks like no Latin one, so look-alikes stay
    texts = ["Ж" + x + m for i, x in enumerate(starters) for m in {*few, marks[i % len(marks)], marks[i * 7 % len(marks)]}]
    texts += ["Ж" + x + m + n for i, x in enumerate(starters) for m, n in [(few[i % 7], few[(i // 7) % 7]), (few[(i + 3) % 7], few[i % 7]), ("\u0301", "\u0323"), (marks[i % len(marks)], few[i % 6])]]
    got = forms(spark, texts)
    assert not [(t, got[i]) for i, t in enumerate(texts) if got[i] != unicodedata.normalize("NFC", t)]


def test_letters_with_marks(spark):
    letters, marks = "aeocnguyxZ", "̧̨̣̀́̂̃̈̊"
    texts = [x + m + n for x in letters for m in marks for n in ["", *marks]]
    texts += ["\u00e9\u0323", "\u00ea\u0323", "\u304b\u3099", "\uff76\uff9e", "a\u0301\u200b\u0323", "\u200b\u0301"]
    got = forms(spark, texts)
    want = [unicodedata.normalize("NFC", t) for t in texts[:-3]] + ["\u30ac", "\u1ea1\u0301", "\u0301"]
    assert [got[i] for i in range(len(texts))] == want


def test_hangul(spark):
    """Every syllable from its letters, one of three as it is, with a tail or a mark behind it."""
    texts = [unicodedata.normalize("NFD", chr(p)) for p in range(0xAC00, 0xD7A4)]
    texts += [chr(p) + "\u11a8" for p in range(0xAC00, 0xD7A4, 3)] + [chr(p) + "\u0323\u1161" for p in range(0xAC00, 0xD7A4, 91)]
    got = forms(spark, texts)
    assert not [(t, got[i]) for i, t in enumerate(texts) if got[i] != unicodedata.normalize("NFC", t)]


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "thе", "en", "", 0), (None, "thе", "en", "", 0), (None, "ｘ", "en", "", 0), (None, None, "en", "", 0), (3, "ｘ", "en", "", 0)], SCHEMA)
    got = sorted((r["row_id"] or 0, r["canonical"] or "") for r in c.canonical_texts(df, "row_id", "text", "lang").collect())
    assert got == [(0, ""), (0, "the"), (0, "the"), (0, "x"), (3, "x")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert c.lookalike_rows([("t", df, "row_id", "text", "lang")]).count() == 0
    assert c.canonical_texts(df, "row_id", "text", "lang").count() == 0


def test_one_exchange(spark):
    df = rows(spark, CASES)
    plan = c.lookalike_rows([("t", df, "row_id", "text", "lang")])._jdf.queryExecution().executedPlan().toString()
    # whole texts, for those with and without marks alike, are all that is exchanged
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert exchanges and all("hashpartitioning(_id" in x and "_k" in x and "REPARTITION_BY_NUM" in x for x in exchanges) and "SortMergeJoin" not in plan
