import numpy as np
import pytest

import __spark_entry__  # noqa: F401
from siftwell.llm import languages as L
from siftwell.runtime import read_table


@pytest.fixture(scope="module")
def model(spark):
    return L.fit_on_documents(read_table(spark, "/root/testdata/sf0.01", "documents"))


def test_labels():
    names = L.label_languages
    assert names("en-US") == names("ENG") == names("English") == {"en"}
    assert names("de;fr") == names("deu + fra") == names("fr/de") == {"de", "fr"}
    assert names("mul") == names("und") == names("") == names(None) == names("??") == names("n/a") == frozenset()


def test_code_words_differ_in_half_the_bits():
    words = L.code_words(10)
    unequal = (words[:, None] != words[None]).sum(-1)
    assert (unequal[~np.eye(10, dtype=bool)] == 8).all()


def test_held_out_accuracy(spark, model):
    rows = read_table(spark, "/root/testdata/sf0.1", "documents").where("doc_id >= 5000 and length(text) > 200").select("text", "lang").toPandas()
    texts, labels = [], []
    for text, lang in zip(rows["text"], rows["lang"]):
        named = L.label_languages(lang)
        if len(named) == 1:
            for s in L.sentences(text)[:1]:
                texts.append(s.text)
                labels.append(next(iter(named)))
    best, sure = model.classify(texts)
    agree = np.mean([L.LANGUAGES[b] == x for b, x in zip(best, labels)])
    assert agree > 0.8  # the labels themselves are wrong in a tenth of the documents
    assert (sure > 0.9).mean() > 0.98


@pytest.mark.parametrize(
    "text,lang",
    [
        ("we counted the pictures near the end of the list", "en"),
        ("niemand konnte die größte datei der gruppe finden", "de"),
        ("niemand konnte die grosste datei der gruppe finden", "de"),
        ("nobody could have kept the largest file", "en"),
        ("posle poslednego progona my perenesli nadpis na plakate", "ru"),
        ("après le dernier passage nous avons trouvé la liste", "fr"),
        ("この絵では 重複の隣で座っている猫が眺めている", "ja"),
    ],
)
def test_sentences_of_each_kind(model, text, lang):
    best, sure = model.classify([text])
    assert L.LANGUAGES[best[0]] == lang


EN = "The archive team moved the largest file of the group. Nobody could explain why our scanner kept the cover."
DE = "Die Übersichtsseite verschob die größte Datei in eine andere Gruppe. Niemand konnte erklären, warum der Scanner sie behielt."
FR1 = "Le dessin montre un chat qui est assis à côté des doublons."


def langs(spark, model, *texts):
    df = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, langs string")
    return [r["langs"] for r in L.document_languages(df, model).orderBy("doc_id").collect()]


def test_rule(spark, model):
    got = langs(
        spark, model,
        f"{EN}\n\n{DE}",
        f"{EN} {DE} {EN}",
        f"{EN} {FR1} {EN}",
        f"{EN}\n\n{FR1}\n\n{EN}",
        FR1,
        f"{EN}\n\n18:32:15 WARN failed to decode 17e94362.gif frame=26\n{{\"id\": \"17e9\", \"keep\": false}}\n[18:33:55] move a.jpeg -> a.jpg",
        "", None, "12345 !!! ???", f"# 18a9ac\n\n{DE.upper()}",
    )
    assert got == [["de", "en"], ["de", "en"], ["en"], ["en", "fr"], ["fr"], ["en"], [], [], [], ["de"]]


def test_cut_off_scraps_bring_in_no_language(spark, model):
    got = langs(spark, model, f"den Abständen 62519 und ...\n\n{EN}", f"{EN} Explique ...", "Kein Bild da.", f"{EN}\n\nKupuzurk vectors ...", f"{EN}\n\nden Abständen 62519 und die Größe der Gruppe bleibt bei allen …")
    assert got == [["en"], ["en"], ["de"], ["en"], ["en"]]


def test_short_paragraphs_count(spark, model):
    got = langs(spark, model, f"{EN}\n\nDas ist ein kurzer Absatz.", f"{EN}\n\nNiemand hat die Datei.\n\n{EN}", f"{EN} Das ist ein Bild. Das war ein Fehler. {EN}", f"{EN}\n\nOk.")
    assert got == [["de", "en"], ["de", "en"], ["de", "en"], ["en"]]


def test_confidence_is_that_of_the_language_given(model):
    found = L.sentences("We moved the largest file of the whole group. Ja. Nobody could explain why it was kept.")
    shares = model.shares([s.text for s in found])
    shares[1] = 0.0
    shares[1, L.LANGUAGES.index("de")] = 0.55
    shares[1, L.LANGUAGES.index("en")] = 0.05
    (run,) = L.segment_runs(found, shares, {}, 0.9)
    letters = np.array([len(s.text) for s in found])
    assert L.LANGUAGES[run.language] == "en" and run.sure == 2
    assert run.confidence == pytest.approx((shares[:, L.LANGUAGES.index("en")] * letters).sum() / letters.sum())


def test_ambiguous_texts_are_flagged(spark, model):
    df = spark.createDataFrame([(1, EN, "en"), (2, "Ok.", "en"), (3, None, "en")], "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: (r["ambiguous"], r["confidence"]) for r in L.document_languages(df, model).collect()}
    assert not got[1][0] and got[1][1] > 0.95 and got[2][0] and got[3] == (False, 0.0)
    assert {r["doc_id"]: r["ambiguous"] for r in L.language_segments(df, model).collect()} == {1: False, 2: True}


def test_long_mark_up_is_no_text(spark, model):
    link = "<a href=\"" + "https://a.example/" + "das/ist/ein/bild/" * 400 + "\">"
    assert langs(spark, model, f"{EN} {link} {EN}") == [["en"]]


def test_fit_takes_long_texts_and_other_languages(spark):
    rows = [(i, (EN if i % 2 else DE) + " " + (EN if i % 2 else DE) * 200, "en" if i % 2 else "de") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.fit_on_documents(df, languages=("de", "en"))
    assert model.languages == ("de", "en")
    assert [r["langs"] for r in L.document_languages(df, model).orderBy("doc_id").collect()] == [["de"], ["en"]] * 4


def test_mislabelled(spark, model):
    rows = [(1, EN, "en"), (2, EN, "de"), (3, EN, None), (4, f"{EN}\n\n{DE}", "en"), (5, f"{EN}\n\n{DE}", "de+en"), (6, "", "en"), (7, None, None), (8, EN, "mul")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {tuple(r) for r in L.mislabelled(L.document_languages(df, model)).collect()}
    assert got == {(2, "en"), (3, "en"), (4, "en"), (4, "de"), (8, "en")}
    assert L.document_languages(df.limit(0), model).count() == 0


def test_segments_have_places(spark, model):
    text = f"{EN}\n\n{DE}"
    rows = L.language_segments(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string"), model).orderBy("segment_no").collect()
    assert [(text[r["start"] : r["end"]], r["lang"], r["sentences"], r["counted"]) for r in rows] == [(EN, "en", 2, True), (DE, "de", 2, True)]
    assert all(r["confidence"] > 0.9 for r in rows)


def test_very_long_text(spark, model):
    assert langs(spark, model, f"{EN} " * 3000, "a" * 300_000) [0] == ["en"]


def test_fit_without_labels(spark):
    df = spark.createDataFrame([(1, EN, None)], "doc_id bigint, text string, lang string")
    model = L.fit_on_documents(df)
    assert L.document_languages(df, model).count() == 1
