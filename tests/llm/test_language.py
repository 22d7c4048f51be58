import pytest

pytest.importorskip("voxmeter.llm")

from voxmeter.llm import language as g  # noqa: E402

TEXTS = {
    "en": "The old lighthouse opens before sunrise and the night train waits for the next signal. Nobody believes that the garden behind the school was the quietest part of the day.",
    "es": "El viejo faro abre antes del amanecer y el tren de la noche espera la siguiente señal. Nadie cree que el jardín detrás de la escuela fue lo más tranquilo del día.",
    "pt": "O velho farol abre antes do amanhecer e o trem da noite espera o próximo sinal. Ninguém acredita que o jardim atrás da escola foi a parte mais tranquila do dia.",
    "nl": "De oude vuurtoren gaat voor zonsopgang open en de nachttrein wacht op het volgende teken. Niemand gelooft dat de tuin achter de school het stilste deel van de dag was.",
    "ky": "Эски маяк күн чыкканга чейин ачылат жана түнкү поезд кийинки белгини күтүп турат. Мектептин артындагы бак күндүн эң тынч бөлүгү болду деп эч ким ишенбейт.",
}
SCHEMA = "doc_id long, text string, lang string, segments string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def profiles(spark):
    labels = {"en": ["en", "EN-us"], "es": ["es_MX"], "pt": ["Pt"], "nl": ["nl"], "ky": ["ky"]}
    return g.fit_profiles(documents(spark, [(TEXTS[k], v) for k, vs in labels.items() for v in vs]), "doc_id", "text", "lang")


def test_found(spark, profiles):
    en, es, pt, nl, ky = TEXTS.values()
    rows = [
        (en, "en"), (en, "en-GB"), (en, "EN_us"), (en, "english"), (en, None), (en, ""), (es, "pt"),
        (en + "\n" + ky.split(". ")[0], "en"),
        ("The night train waits for the next signal, mas o jardim atrás da escola foi a parte mais tranquila do dia.", "en"),
        ("The old lighthouse waits: «жылдыз» and «күндүн» before sunrise.", "en"),
        ("Muchas gracias.", "nl"), ("", "en"), (None, None), ("   \n 12 34 | {\"clip\": 1}", "en"), (pt + " “" + nl.split(". ")[0] + ".”", "pt_BR"),
        (es.upper(), "es"), ("señal " * 500 + es, "es"),
    ]
    segmented = g.language_segments(documents(spark, rows), "doc_id", "text", ["lang"], profiles)
    got = sorted((r["doc_id"], r["lang"]) for r in g.unnamed_languages(segmented, "doc_id", "lang").collect())
    assert got == [(3, "en"), (4, "en"), (5, "en"), (6, "es"), (7, "ky"), (8, "pt"), (14, "nl")]
    whole = {r["doc_id"]: r for r in g.document_languages(segmented, "doc_id", "lang").collect()}
    assert len(whole) == len(rows) and whole[10]["lang"] == "es" and whole[10]["languages"] == [] and whole[12]["lang"] is None
    assert 0 < whole[0]["confidence"] <= 1 and whole[7]["languages"] == ["en", "ky"]
    cut = segmented.where("doc_id = 7").first()["segments"]
    assert [s["lang"] for s in cut] == ["en", "ky"] and rows[7][0][cut[1]["start"] :].startswith("Эски")


def test_clauses():
    found = g.clauses("A: Hello, big world! [00:03] x=1 kam_1.wav 12 voices wer=0.2\nNext line – and a dash")
    assert [c.words for c in found] == [["hello"], ["big", "world"], ["voices"], ["next", "line"], ["and", "a", "dash"]]
    assert [c.counted for c in found] == [1, 2, 2, 2, 3]
    assert g.clauses("") == [] and g.clauses(" \n ") == []
    assert g.clauses("theater theater theatre Theater play")[0].words == ["theater", "play"]


@pytest.mark.parametrize("pair", ["sintética necesita", "coat cannot", "tarde durante", "puerto porque", "porto perto", "vorige vroeg", "кабары акыркы", "their three", "калып калды калың"])
def test_different_words_count_as_two(pair):
    clause = g.clauses("w " + pair + " x")[0]
    assert clause.words == ["w", *pair.split(), "x"] and clause.counted == 2 + len(pair.split())


def test_mistyped_runs_count_once():
    for run in ("teacher techer teachr", "plat plant plant plant", "barco barco baco barco brco barco", "tacher teacher teaher teacher"):
        clause = g.clauses(f"a {run} b")[0]
        assert clause.words == ["a", run.split()[0], "b"] and clause.counted == 3


def test_near_words_are_evidence(spark, profiles):
    """Six words, two of them alike, are enough for a text to be written in a language."""
    segmented = g.language_segments(documents(spark, [("El puerto porque el tren espera.", "en")]), "doc_id", "text", ["lang"], profiles)
    assert [(r["doc_id"], r["lang"]) for r in g.unnamed_languages(segmented, "doc_id", "lang").collect()] == [(0, "es")]


def test_out_of_place_distance():
    p = g.Profiles({"a": ["x", "y", "z"], "b": ["z", "y", "w"]}, size=3, longest=1)
    d, n = p.distances([["xy"], [], ["q"]])
    # x is first and y second in a: no difference; in b, x is absent (3) and y in its place (0)
    assert d[0].tolist() == [0.0, 3 / 2 / 3] and d[1].tolist() == d[2].tolist() == [1.0, 1.0] and n.tolist() == [2, 0, 0]


def test_empty_tables(spark, profiles):
    none = documents(spark, []) if False else spark.createDataFrame([], SCHEMA)
    assert g.language_segments(none, "doc_id", "text", ["lang"], profiles).count() == 0
    blank = g.fit_profiles(none, "doc_id", "text", "lang")
    one = g.language_segments(documents(spark, [(TEXTS["en"], None)]), "doc_id", "text", ["lang"], blank)
    assert one.first()["segments"] == []
