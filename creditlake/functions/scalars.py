"""Scalar functions. Each takes Columns (or column names) and returns a Column.

Everything here is a built-in expression, so it stays inside whole-stage
code generation; there is no Python UDF in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from both ends of a text field.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Customer segments by monthly income.
PREMIUM_INCOME = 150000
MASS_AFFLUENT_INCOME = 70000

# Utilization bands by total disbursed.
HIGH_UTILIZATION = 1000000
MODERATE_UTILIZATION = 250000

# The transaction risk score.
BASE_SCORE = 20
VERY_LARGE_AMOUNT, VERY_LARGE_POINTS = 150000, 45
LARGE_AMOUNT, LARGE_POINTS = 80000, 25
CASH_OUT_POINTS = 15
POINTS_PER_ALERT, MAX_ALERT_POINTS = 5, 20
MAX_SCORE = 99

# The batch rule for large cash movements.
MOVEMENT_AMOUNT = 150000
CASH_OUT_MOVEMENT_AMOUNT = 90000

MONEY = "decimal(18,2)"

# Numbers in text are read exactly, to 18 decimals and below 10^15.
NUMBER = "decimal(33,18)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean(value: Column | str) -> Column:
    """Text without surrounding whitespace; NULL becomes the empty text."""
    return F.trim(F.coalesce(_col(value).cast("string"), F.lit("")), F.lit(BLANKS))


def code(value: Column | str) -> Column:
    """A cleaned identifier in upper case."""
    return F.upper(clean(value))


def label(value: Column | str) -> Column:
    """A cleaned category in lower case."""
    return F.lower(clean(value))


def title(value: Column | str) -> Column:
    """Capital after every non-letter: ``mary-jane o'brien`` to ``Mary-Jane O'Brien``."""
    runs = F.regexp_extract_all(F.lower(clean(value)), F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return F.array_join(F.transform(runs, F.initcap), "")


def parse_decimal(value: Column | str) -> Column:
    """Exact number from text. Unparsable text gives 0, and so do numbers that are :func:`out_of_range`."""
    return F.coalesce(clean(value).try_cast(NUMBER), F.lit(0).cast(NUMBER))


def out_of_range(value: Column | str) -> Column:
    """Whether the text is a number too large to be read. :func:`parse_decimal` makes it 0, so rows with it are rejected."""
    text = clean(value)
    size = F.abs(text.try_cast("double"))
    return F.coalesce(text.try_cast(NUMBER).isNull() & (size >= 1e15) & ~F.isnan(size), F.lit(False))


def round_money(value: Column) -> Column:
    """Two decimals, ties to the even cent. Decimal input only."""
    return F.bround(value, 2).cast(MONEY)


def money(value: Column | str) -> Column:
    return round_money(parse_decimal(value))


def optional_money(value: Column | str) -> Column:
    """Like :func:`money`, but NULL when the text is not a number."""
    return round_money(clean(value).try_cast(NUMBER))


def whole_number(value: Column | str) -> Column:
    """Integer part of a number in text, truncated towards zero."""
    return parse_decimal(value).cast("bigint")


def parse_date(value: Column | str) -> Column:
    """A ``yyyy-MM-dd`` date, or NULL when the text is anything else."""
    text = clean(value)
    return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def parse_timestamp(value: Column | str) -> Column:
    return clean(value).try_cast("timestamp")


def date_key(day: Column | str) -> Column:
    """A date as the integer ``YYYYMMDD``."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "EEEE")


def padded_id(prefix: str, number: Column | str, width: int) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers are kept whole."""
    number = _col(number)
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(number < 10**width, F.lpad(digits, width, "0")).otherwise(digits))


def customer_segment(monthly_income: Column | str, defaulted_loans: Column | int = 0) -> Column:
    income = _col(monthly_income)
    defaulted = F.lit(defaulted_loans) if isinstance(defaulted_loans, int) else defaulted_loans
    return (
        F.when(defaulted > 0, "high_risk")
        .when(income >= PREMIUM_INCOME, "premium")
        .when(income >= MASS_AFFLUENT_INCOME, "mass_affluent")
        .otherwise("emerging")
    )


def utilization_band(total_disbursed: Column | str) -> Column:
    total = _col(total_disbursed)
    return (
        F.when(total >= HIGH_UTILIZATION, "high_utilization")
        .when(total >= MODERATE_UTILIZATION, "moderate_utilization")
        .when(total > 0, "low_utilization")
        .otherwise("no_loans")
    )


def is_cash_out(transaction_type: Column | str) -> Column:
    return F.coalesce(F.lower(_col(transaction_type)) == "cash_out", F.lit(False))


def unaided_score(amount: Column | str, transaction_type: Column | str) -> Column:
    """Risk score of a transaction whose customer has no earlier alerts."""
    amount = _col(amount)
    size = (
        F.when(amount >= VERY_LARGE_AMOUNT, VERY_LARGE_POINTS)
        .when(amount >= LARGE_AMOUNT, LARGE_POINTS)
        .otherwise(0)
    )
    return F.lit(BASE_SCORE) + size + F.when(is_cash_out(transaction_type), CASH_OUT_POINTS).otherwise(0)


def risk_score(
    amount: Column | str, transaction_type: Column | str, recent_alerts: Column | int = 0
) -> Column:
    recent = F.lit(recent_alerts) if isinstance(recent_alerts, int) else recent_alerts
    bonus = F.least(recent * POINTS_PER_ALERT, F.lit(MAX_ALERT_POINTS))
    return F.least(unaided_score(amount, transaction_type) + bonus, F.lit(MAX_SCORE)).cast("int")


def alert_rule(amount: Column | str, transaction_type: Column | str) -> Column:
    risky = is_cash_out(transaction_type) & (_col(amount) >= LARGE_AMOUNT)
    return F.when(risky, "risky_cash_out").otherwise("high_value_transaction")


def is_large_movement(amount: Column | str, transaction_type: Column | str) -> Column:
    amount = _col(amount)
    return (amount >= MOVEMENT_AMOUNT) | (
        is_cash_out(transaction_type) & (amount >= CASH_OUT_MOVEMENT_AMOUNT)
    )


def due_date(disbursed: Column | str, term_months: Column | str) -> Column:
    """Thirty days for every month of the term."""
    return F.date_add(_col(disbursed), (_col(term_months) * 30).cast("int"))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent to two decimals, 0 when ``whole`` is 0.

    Operands are narrowed so that the quotient keeps 14 decimals.
    """
    wide = "decimal(24,2)"
    ratio = F.try_divide(part.cast(wide), whole.cast(wide))
    return F.coalesce(F.bround(ratio * 100, 2), F.lit(0)).cast("decimal(38,2)")


def now() -> Column:
    """Current time in whole seconds."""
    return F.date_trunc("second", F.current_timestamp())


def run_id(started: Column) -> Column:
    return F.date_format(started, "yyyyMMdd'T'HHmmss'Z'")
