import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regain import config as c
from regain.functions.numbers import round_half_away, safe_div
from regain.functions.text import SPACES, blank_to_null, clean_text, fmt_money, matches, to_amount, to_date_strict, to_int


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()[0]


@pytest.mark.parametrize("raw, clean", [
    ("Danâ\u0080\u0099s", "Dan's"), ("cafÃ¡", "cafá"), ("RosÃ¨", "Rosè"), ("aÂ b", "a b"),
    ("a b", "a b"), ("a\u0000b", "ab"), ("  x ", "x"), ("   ", None), ("  　", None), (None, None),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, clean_text("x")) == clean


@pytest.mark.parametrize("raw, day", [("9/8/2026", dt.date(2026, 9, 8)), ("09/08/2026", dt.date(2026, 9, 8)), (" ", None), (None, None)])
def test_dates(spark, raw, day):
    assert one(spark, raw, to_date_strict("x")) == day


@pytest.mark.parametrize("raw, cast", [("13/45/2026", to_date_strict), ("7.6", to_int), ("1,234", to_amount), ("   ", to_amount)])
def test_bad_values_fail(spark, raw, cast):
    with pytest.raises(Exception):
        one(spark, raw, cast("x"))


@pytest.mark.parametrize("value, text", [("1234.5", "$1,235"), ("-250", "-$250"), ("0", "$0"), ("1000000.4", "$1,000,000")])
def test_money_text(spark, value, text):
    assert one(spark, Decimal(value), fmt_money(F.col("x")), "decimal(18,4)") == text


@pytest.mark.parametrize("po, hit", [
    ("CONSIGNMENT", True), ("COSINGMENT", True), ("COMSIGNMENT", True), ("CONSTRUCTION JOB", False), ("CONSULTING", False),
    ("BISCONSIGN", False), ("ÉCONSIGN", True),
])
def test_consignment_word(spark, po, hit):
    assert one(spark, po, matches(F.col("x"), c.CONSIGN_WORD)) is hit


@pytest.mark.parametrize("po, hit", [("CON T 4/21", True), ("CON/T", True), ("CONE", False), ("X CONS.", True), ("CON_A", False), ("ÉCON", True)])
def test_consignment_abbreviation(spark, po, hit):
    assert one(spark, po, matches(F.col("x"), c.CONSIGN_ABBREVIATION)) is hit


def test_numbers(spark):
    assert one(spark, -1.25, round_half_away(F.col("x"), 1), "double") == -1.3
    assert one(spark, 3.0, safe_div(F.col("x"), F.lit(0)), "double") is None


def test_trimming_by_the_set_is_for_text_beyond_ascii_only(spark):
    """Every text was trimmed character by character before; both ways give the same."""
    spaces = ["", " ", "  ", " ", " 　 ", " "]
    inner = [None, "", "a", "a b", "é", "x y", "\t", "\u0000", "€ 5"]
    rows = [(None if t is None else a + t + b,) for a in spaces for t in inner for b in spaces]
    df = spark.createDataFrame(rows, "t string")
    whole = F.nullif(F.trim("t", F.lit(SPACES)), F.lit(""))
    assert df.select(blank_to_null(F.col("t")).alias("a"), whole.alias("b")).filter("NOT (a <=> b)").isEmpty()
    assert "CASE WHEN" in df.select(blank_to_null(F.col("t")))._jdf.queryExecution().analyzed().toString()
