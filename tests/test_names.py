import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propfold.functions import names as n
from propfold.functions import scripts


def by_hand(text: str) -> str:
    for old, new in n.REPLACEMENTS:
        text = text.replace(old, new)
    out = []
    for ch in text:
        base, *marks = unicodedata.normalize("NFD", ch)
        if ch in n.SINGLE or ch in n.SEVERAL:
            out.append({**n.SINGLE, **n.SEVERAL}[ch])
        elif unicodedata.combining(ch) and 0x300 <= ord(ch) < 0x370:
            continue
        elif ch in scripts.letters():
            out.append(scripts.letters()[ch])
        elif scripts.HANGUL_FIRST <= ord(ch) <= scripts.HANGUL_LAST:
            out.append(scripts.hangul(ch))
        elif marks and base.isascii() and all(map(unicodedata.combining, marks)):
            out.append(base)
        else:
            out.append(ch)
    return "".join(out)


def normalised(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "name string")
    return [r[0] for r in rows.select(n.identifier("name")).collect()]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("VALOR TOTAL", "valor_total"),
        ("Correo |Año", "correo_ano"),
        ("Nº Caracteres", "no_caracteres"),
        ("a  b", "a_b"),
        ("a   b", "a__b"),
        ("a    b", "a__b"),
        ("a     b", "a_b"),
        ("a      b", "a_b"),
        ("a       b", "a__b"),
        ("a        b", "a__b"),
        ("Straße", "strasse"),
        ("Æther œuvre", "aether_oeuvre"),
        ("precio €", "precio_eur"),
        ("Đặng Łódź Øre", "dang_lodz_ore"),
        ("e\u0301te\u0301", "ete"),
        ("it's", "it's"),
        ("Москва Щука", "moskva_shchuka"),
        ("Αθήνα Ψυχή", "athena_psukhe"),
        ("Երևան 2", "erewan_2"),
        ("თბილისი", "t'bilisi"),
        ("שלום", "shlvm"),
        ("سلام", "slam"),
        ("한국어 값", "hangugeo_gabs"),
        ("カナ ひらがな", "kana_hiragana"),
        ("がっこう づ", "gatukou_du"),
        ("日本", "日本"),
        ("１２３ ａｂＣ", "123_abc"),
        ("٣٤ ½ ﬁn Ⅻ", "34_1/2_fin_xii"),
        ("£5 ¥ § ŉ", "ps5_y=_ss_'n"),
        ("Ж🙂é", "zh🙂e"),
        ("a\\b", "a\\b"),
        ("", ""),
    ],
)
def test_identifier(spark, raw, clean):
    assert normalised(spark, [raw]) == [clean]


def test_missing_name_stays_missing(spark):
    assert normalised(spark, [None]) == [None]


def test_key_is_the_upper_case_form(spark):
    rows = spark.createDataFrame([("Correo |Año",)], "name string")
    assert rows.select(n.comparison_key("name")).first()[0] == "CORREO_ANO"


def test_letter_table_is_one_to_one():
    old, new = n.one_to_one()
    assert len(old) == len(new) + len(n.COMBINING)
    assert len(set(old)) == len(old)
    assert new.isascii()


LETTERS = st.text(alphabet=" _|aZ'\"\\ñÁßø€éü–\u0301中", max_size=14)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LETTERS, min_size=20, max_size=120))
def test_identifier_equals_the_rule_by_hand(spark, texts):
    found = normalised(spark, texts)
    assert found == [by_hand(t).lower() for t in texts]
    assert not any("|" in f or " " in f for f in found)


@pytest.mark.parametrize("known", [{}, {"K": "k"}, {"VALOR TOTAL": "valor_total", "Correo |Año": "correo_ano"}])
def test_known_spellings_do_not_change_the_result(spark, known):
    names = ["VALOR TOTAL", "Valor Total", "K", "Correo |Año", None, "ß" * 300] * 7
    rows = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    found = n.with_identifier(rows, "name", "clean", known).orderBy("id").collect()
    assert [r["clean"] for r in found] == [t if t is None else by_hand(t).lower() for t in names]
    assert [r["name"] for r in found] == names


def test_identifier_is_stable(spark):
    once = normalised(spark, ["Valor Total", "Correo |Año"])
    assert normalised(spark, once) == once
    rows = spark.createDataFrame([(t,) for t in once], "name string")
    assert rows.where(F.col("name") == n.identifier("name")).count() == len(once)
