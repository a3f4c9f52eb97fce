"""Months, text, names and score formulas."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from monthbook.functions.months import (
    parse_lag, parse_lag_col, previous_month, previous_month_col, shift_month,
    shift_month_col, window_start)
from monthbook.functions.scalars import clip, safe_divide
from monthbook.functions.text import feature_name, normalize_text, normalize_text_col

# Expected values of the normalisation.
PAIRS = {
    "CAFÉ COM AÇÚCAR": "cafe_com_acucar", "SÃO PAULO": "sao_paulo", "PARANÁ": "parana",
    "AMANHÃ": "amanha", "AÇÃO/REAÇÃO": "acao_reacao", "R$ 100,00": "r_100_00",
    "E-COMMERCE": "e_commerce", "24/7": "24_7", "CARTÃO CRÉDITO": "cartao_credito",
    "TRANSFERÊNCIA-PIX": "transferencia_pix",
}
HARD = ["ﬁm ½ Straße ㎏ 𝐀bc º ª", "é ö", "__a__b--c", "", "日本 x", "①②⑴", "ŒUVRE"]


def test_normalize_text_on_driver():
    assert {t: normalize_text(t) for t in PAIRS} == PAIRS
    assert normalize_text("ﬁm ½ º") == "fim_1_2_o"


def test_normalize_text_column_agrees_with_driver(spark):
    texts = [*PAIRS, *HARD]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", normalize_text_col(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: normalize_text(t) for t in texts}


def test_every_letter_of_the_first_planes_agrees(spark):
    points = [p for p in range(1, 0x3000) if not 0xD800 <= p < 0xE000]
    df = spark.createDataFrame([(p, f"a{chr(p)}b") for p in points], "p int, t string")
    got = df.select("t", normalize_text_col(F.col("t")).alias("n")).collect()
    assert [r.t for r in got if r.n != normalize_text(r.t)] == []


def test_feature_names():
    assert feature_name("valor_transacao", "SUM", 3) == "valor_transacao_sum_3m"
    assert feature_name("Préço", "avg") == "preco_avg"
    assert feature_name("x", "max", 0) == "x_max"
    assert (feature_name("v", "count", 1, "tipo_dispositivo", "ROOTED/JAILBREAK")
            == "v_tipo_dispositivo_rooted_jailbreak_count_1m")


@pytest.mark.parametrize("month,by,expected", [
    ("202401", -1, "202312"), ("202312", 1, "202401"), ("202305", -1, "202304"),
    ("2023-05", -1, "2023-05"), (202301, -13, "202112")])
def test_shift_month(month, by, expected):
    assert shift_month(month, by) == expected


def test_window_start_includes_the_reference_month():
    assert window_start("202402", 12) == "202303"
    assert window_start("202402", 1) == "202402"


@settings(max_examples=50, deadline=None)
@given(st.integers(1900, 2100), st.integers(1, 12), st.integers(-500, 500))
def test_shift_month_is_invertible(year, month, by):
    text = f"{year}{month:02d}"
    assert shift_month(shift_month(text, by), -by) == text


def test_shift_month_column_agrees(spark):
    rows = [(m, k) for m in ("199901", "202312", "202402", "oops", "2024-1")
            for k in (-25, -12, -1, 0, 1, 11, 24)]
    df = spark.createDataFrame(rows, "m string, k int")
    got = df.select("m", "k", shift_month_col(F.col("m"), F.col("k")).alias("s")).collect()
    assert [(r.m, r.k, r.s) for r in got if r.s != shift_month(r.m, r.k)] == []


def test_lags(spark):
    texts = {"": 0, "m": 0, "M": 0, "m-1": 1, "M-12": 12, " m - 3 ": 3}
    assert {t: parse_lag(t) for t in texts} == texts
    assert parse_lag(None) == 0
    with pytest.warns(UserWarning):
        assert parse_lag("later") == 0
    df = spark.createDataFrame([(t,) for t in [*texts, None, "later"]], "t string")
    got = {r.t: r.k for r in df.select("t", parse_lag_col(F.col("t")).alias("k")).collect()}
    assert got == {**texts, None: 0, "later": 0}


def test_previous_month(spark):
    assert previous_month(dt.date(2024, 1, 31)) == "202312"
    df = spark.createDataFrame([(dt.date(2024, 3, 31),)], "d date")
    assert df.select(previous_month_col(F.col("d"))).first()[0] == "202402"


def test_safe_divide_and_clip(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2), (3, None)], "a int, b int")
    got = [r[0] for r in df.select(safe_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 0.5, None, None]
    got = [r[0] for r in df.select(clip(F.col("a"), 2.0, 2.5)).collect()]
    assert got == [2.0, 2.0, None, 2.5]
