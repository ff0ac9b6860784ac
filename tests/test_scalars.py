from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from creditlake.functions import scalars as S


def values(spark, texts, make):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(make("t")).collect()]


def test_clean_strips_every_blank_and_keeps_the_inside(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [b + "a  b" + b for b in blanks] + [None, "", " \t ", "​x"]
    assert values(spark, texts, S.clean) == [(t or "").strip() for t in texts]


def test_title_matches_capital_after_non_letter(spark):
    texts = ["mary-jane o'brien", "JOHN  smith", "3rd floor", "", None, "élan vital"]
    assert values(spark, texts, S.title) == [(t or "").strip().title() for t in texts]


def test_money_rounds_half_to_even_and_defaults_to_zero(spark):
    texts = ["2.345", "2.335", "", None, "abc", "1e3", " 12 ", "-0.005", "999999999999999.99", "1e15", "NaN", "1_000"]
    expected = ["2.34", "2.34", "0", "0", "0", "1000", "12", "0", "999999999999999.99", "0", "0", "0"]
    assert values(spark, texts, S.money) == [Decimal(e) for e in expected]


def test_whole_number_truncates(spark):
    assert values(spark, ["0.5", "12.7", "-3.9", "x"], S.whole_number) == [0, 12, -3, 0]


def test_parse_date_wants_the_full_pattern(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-2-3", "20240203", "2024-02-03T00:00", " 2024-02-03 ", None]
    found = [str(d) if d else None for d in values(spark, texts, S.parse_date)]
    assert found == ["2024-02-29", None, None, None, None, "2024-02-03", None]


def test_date_parts(spark):
    row = spark.sql("SELECT date'2024-02-29' AS d").select(S.date_key("d"), S.day_name("d")).first()
    assert tuple(row) == (20240229, "Thursday")


def test_padded_id_keeps_long_numbers(spark):
    row = spark.range(1).select(S.padded_id("A", F.lit(7), 3), S.padded_id("A", F.lit(12345), 3)).first()
    assert tuple(row) == ("A007", "A12345")


@pytest.mark.parametrize(
    "income, defaulted, expected",
    [
        ("150000", 0, "premium"),
        ("149999.99", 0, "mass_affluent"),
        ("70000", 0, "mass_affluent"),
        ("69999.99", 0, "emerging"),
        ("200000", 1, "high_risk"),
    ],
)
def test_customer_segment(spark, income, defaulted, expected):
    amount = F.lit(income).cast(S.MONEY)
    assert spark.range(1).select(S.customer_segment(amount, F.lit(defaulted))).first()[0] == expected


def test_utilization_band(spark):
    amounts = ["1000000", "999999.99", "250000", "249999.99", "0.01", "0"]
    found = values(spark, amounts, lambda c: S.utilization_band(F.col(c).cast(S.MONEY)))
    high, moderate, low = "high_utilization", "moderate_utilization", "low_utilization"
    assert found == [high, moderate, moderate, low, low, "no_loans"]


@pytest.mark.parametrize(
    "amount, kind, recent, expected",
    [
        ("150000", "cash_out", 0, 80),
        ("80000", "transfer", 0, 45),
        ("79999.99", "CASH_OUT", 0, 35),
        ("150000", "cash_out", 4, 99),
        ("150000", "cash_out", 9, 99),
        ("10", None, 2, 30),
        ("10", " cash_out", 0, 20),
    ],
)
def test_risk_score(spark, amount, kind, recent, expected):
    score = S.risk_score(F.lit(amount).cast(S.MONEY), F.lit(kind).cast("string"), recent)
    assert spark.range(1).select(score).first()[0] == expected


def test_percent_is_zero_without_a_whole(spark):
    zero, one, three = (F.lit(n).cast("decimal(38,2)") for n in (0, 1, 3))
    row = spark.range(1).select(S.percent(one, three), S.percent(one, zero)).first()
    assert tuple(row) == (Decimal("33.33"), Decimal("0.00"))


def test_run_id(spark):
    stamp = F.lit("2024-05-06 07:08:09").cast("timestamp")
    assert spark.range(1).select(S.run_id(stamp)).first()[0] == "20240506T070809Z"
