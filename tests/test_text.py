import datetime
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import text as T
from marketlens.functions.display import code_label, fmt_br_money, fmt_br_number, fmt_br_percent, label_code


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


def reference_normal(value):
    upper = unicodedata.normalize("NFKD", (value or "").strip().upper())
    kept = "".join(ch for ch in upper if not unicodedata.combining(ch))
    out, space = [], False
    for ch in kept:
        if ch.isspace():
            if not space:
                out.append(" ")
            space = True
        else:
            out.append(ch)
            space = False
    return "".join(out)


def test_clean_cell(spark):
    values = ["﻿ a b \t", None, "", " x ", "a﻿b", "\x1cq\x85"]
    assert apply(spark, T.clean_cell, values) == ["a b", "", "", "x", "ab", "q"]


def test_normalize_text_examples(spark):
    values = ["São José", "Ação x", "ß straße", "ﬁm", " a\tb\n", None, "½ ª º ™ …", "각 한국", "\U0001d400bc", "é x", "ẛ̣"]
    assert apply(spark, T.normalize_text, values) == [reference_normal(v) for v in values]
    assert [T.normalize_name(v) for v in values[:3]] == ["SAO JOSE", "ACAO X", "SS STRASSE"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24FF, exclude_categories=("Cs", "Cn", "Cc"))), min_size=40, max_size=80))
def test_normalize_text_is_nfkd(spark, values):
    # Upper-case tables differ between Unicode versions; start from upper-case text.
    values = [v.upper() for v in values if v.upper() == v.upper().upper()]
    assert apply(spark, T.fold_accents, values) == [
        "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)) for v in values
    ]


def test_numbers(spark):
    values = ["1.234.567,89", "0,00", "", "abc", "74500.10", "1e3", "1.5d", "1_0", None, " 7 ", "-3,5"]
    assert apply(spark, T.parse_br_number, values) == [1234567.89, 0.0, None, None, 7450010.0, 1000.0, None, None, None, 7.0, -3.5]
    auto = lambda c: T.parse_br_number(c, "auto")
    assert apply(spark, auto, ["74500.10", "1.234.567,89", "1.234.567", "12"]) == [74500.10, 1234567.89, 1234567.0, 12.0]
    with pytest.raises(ValueError):
        T.parse_br_number("v", "xx")


def test_dates_and_ages(spark):
    values = ["20180115", "00000000", "0", "20230229", "2018115", " 20180115 ", None, "20300101"]
    day = datetime.date(2018, 1, 15)
    assert apply(spark, T.parse_yyyymmdd, values) == [day, None, None, None, None, day, None, datetime.date(2030, 1, 1)]
    age = lambda c: T.age_years(T.parse_yyyymmdd(c), "2024-01-01")
    assert apply(spark, age, ["20180115", "20231231", None, "20300101"]) == [6, 1, 0, 0]


def test_codes(spark):
    assert apply(spark, T.only_digits, ["a1-2", None, "x"]) == ["12", "", ""]
    assert apply(spark, T.porte_label, ["00", "01", "03", "05", "", "99", None]) == [
        "Nao informado", "Microempresa", "Empresa de pequeno porte", "Demais", None, "99", None,
    ]
    assert apply(spark, T.is_strange_uf, [" sc ", "Sc", "", "9X", "ABC", None, "ÁÉ"]) == [False, False, True, True, True, True, False]
    row = spark.sql("SELECT '1' a, '2' b, cast(null as string) c")
    assert row.select(T.cnpj_key("a", "b", "b"), T.cnpj_key("a", "b", "c")).first()[:] == ("122", None)


def test_display(spark):
    assert apply(spark, fmt_br_number, [1234567.0, None, 0.5, 1.5], "double") == ["1.234.567", "-", "0", "2"]
    assert apply(spark, lambda c: fmt_br_number(c, 1), [1234.56], "double") == ["1.234,6"]
    assert apply(spark, fmt_br_money, [1234.5, None], "double") == ["R$ 1.234,50", "R$ -"]
    compact = lambda c: fmt_br_money(c, compact=True)
    assert apply(spark, compact, [2.5e9, -1.25e6, 1000.0, 12.0, None], "double") == [
        "R$ 2,5 bi", "R$ -1,2 mi", "R$ 1,0 mil", "R$ 12,00", "-",
    ]
    assert apply(spark, fmt_br_percent, [12.34, None], "double") == ["12,3%", "-"]
    assert apply(spark, lambda c: label_code(code_label(c, F.lit(None).cast("string"))), ["62"]) == ["62"]


def test_unreadable_numbers_show_as_dash(spark):
    assert apply(spark, fmt_br_number, ["abc", "12"]) == ["-", "12"]
