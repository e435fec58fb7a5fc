import unicodedata

from hypothesis import given
from hypothesis import strategies as st

from tessellum.llm.canon import consistent_form
from tessellum.llm.fold import bare, look_alike


def forms(spark, texts):
    df = spark.createDataFrame([(i, t, "c", "v") for i, t in enumerate(texts)], "id int, t string, canonical string, value string")
    return [r["canonical"] for r in consistent_form(df, "t").orderBy("id").collect()]


def test_dirty_forms_come_out_clean(spark):
    dirty = {
        "Ｌａ ｐｅｎｔｅ": "La pente", "аrrіèrе": "arrière", "Densité": "Densité", "43­": "43", "r͏èglement": "règlement", " le": "le", " a ": "a",
        "une zone": "une zone", "oﬃciel": "officiel", "ϹⅤ-268": "CV-268", "Ⅷ": "VIII", "Chaş": "Chaş", "２．": "2.", "﻿": "", "   ": "",
    }
    assert forms(spark, list(dirty)) == list(dirty.values())


def test_ordinary_signs_stay(spark):
    plain = ["« l’œuvre » – 5 m² ½", "Ω-9 Δ β λ", "1° ex æquo", "", None, "a  b", "…•"]
    assert forms(spark, plain) == plain


def test_loose_marks_and_order_of_marks_are_one_class(spark):
    got = forms(spark, ["q̣̇", "q̣̇", "ậ", "ậ"])
    assert got[0] == got[1] and got[2] == got[3] == "ậ"


def test_case_and_accents_keep_classes_apart(spark):
    assert forms(spark, ["a", "A", "é", "e", "œ", "oe"]) == ["a", "A", "é", "e", "œ", "oe"]


def test_repeated_rows_long_text_and_empty_table(spark):
    assert forms(spark, ["dе"] * 3) == ["de"] * 3
    long = "mоt " * 50_000
    assert forms(spark, [long])[0] == ("mot " * 50_000).strip()
    df = spark.createDataFrame([], "t string")
    assert consistent_form(df, "t").columns == ["t", "canonical"] and consistent_form(df, "t").count() == 0


@given(st.text(max_size=40))
def test_bare_is_stable_and_ignores_marks(text):
    once = bare(text)
    assert bare(once) == once or unicodedata.normalize("NFKD", once) != once
    assert bare("é́e​e") == "eee"


def test_look_alike():
    assert [look_alike(c) for c in "аΑＡⅬ​ ²œ"] == ["a", "A", "A", "L", "", " ", None, None]


def test_words_of_other_scripts_and_single_characters(spark):
    rows = [("Россия",), ("Роssия",), ("соре",), ("Հայաստան",), ("Kilo",), ("a;",), ("x\U000e0101y",), ("дом AСB",)]
    got = {r["t"]: r["c"] for r in consistent_form(spark.createDataFrame(rows, "t string"), "t", out="c").collect()}
    assert got == {"Россия": "Россия", "Роssия": "Possия", "соре": "cope", "Հայաստան": "Հայաստան", "Kilo": "Kilo", "a;": "a;", "x\U000e0101y": "xy", "дом AСB": "дом ACB"}
