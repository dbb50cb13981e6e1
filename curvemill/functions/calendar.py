"""Calendar arithmetic as column expressions.

Every function takes a date column and works on whole tables. Where a function takes
"today", the caller passes it; nothing here reads a clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"

# Months per period of the refresh frequencies that are counted in months.
FREQUENCY_MONTHS = {"monthly": 1, "quarterly": 3, "semi-annually": 6, "annually": 12}


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_weekend(day: str | Column) -> Column:
    return F.weekday(_col(day)) >= 5


def is_business_day(day: str | Column) -> Column:
    """Monday to Friday; holidays are not known."""
    return F.weekday(_col(day)) < 5


def last_month_end(day: str | Column) -> Column:
    return F.last_day(F.add_months(_col(day), -1))


def last_quarter_end(day: str | Column) -> Column:
    """Last day of the quarter before the one holding the date."""
    return F.date_sub(F.trunc(_col(day), "quarter"), 1)


def quarter_end(day: str | Column) -> Column:
    """Last day of the quarter holding the date."""
    return F.last_day(F.add_months(F.trunc(_col(day), "quarter"), 2))


def next_month_start(day: str | Column) -> Column:
    return F.add_months(F.trunc(_col(day), "month"), 1)


def report_date(inception: str | Column) -> Column:
    """Data stamped on the 1st of a month reports the end of the month before."""
    return last_month_end(inception)


def nth_business_date(day: str | Column, n: int | Column) -> Column:
    """The n-th business date after the 1st of the month; the 1st is never counted.

    Counted arithmetically: a weekend start moves back to its Friday, whole weeks add
    seven days, and a remainder that passes Friday skips one weekend.
    """
    if isinstance(n, int):
        if n <= 0:
            raise ValueError("n must be positive")
        n = F.lit(n)
    else:
        n = F.when(n > 0, n).otherwise(F.raise_error(F.lit("n must be positive")).cast("int"))
    first = F.trunc(_col(day), "month")
    weekday = F.weekday(first)
    start = F.when(weekday > 4, F.date_sub(first, weekday - 4)).otherwise(first)
    position = F.least(weekday, F.lit(4))
    rest = n % 5
    skip = F.when(position + rest > 4, 2).otherwise(0)
    weeks = F.floor(n / 5).cast("int")
    return F.date_add(start, (weeks * 7 + rest + skip).cast("int"))


def date_to_text(day: str | Column, fmt: str = DAY_FORMAT) -> Column:
    return F.date_format(_col(day), fmt)


def text_to_date(text: str | Column, fmt: str = DAY_FORMAT) -> Column:
    """Null where the text is not a date of this format."""
    return F.try_to_date(_col(text), fmt)


def quarter_code(day: str | Column) -> Column:
    """2026-06-30 -> 26Q2"""
    day = _col(day)
    return F.concat(F.date_format(day, "yy"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_code_to_date(code: str | Column) -> Column:
    """26Q2 -> 2026-06-30; a quarter outside 1 to 4 fails."""
    code = _col(code)
    year = F.substring(code, 1, 2).cast("int") + 2000
    quarter = F.substring(code, -1, 1).cast("int")
    ended = F.last_day(F.make_date(year, quarter * 3, F.lit(1)))
    wrong = F.raise_error(F.concat(F.lit("invalid quarter code: "), code)).cast("date")
    return F.when(quarter.between(1, 4), ended).when(code.isNotNull(), wrong)


def forecast_code(day: str | Column) -> Column:
    """2026-05-11 -> 26Q2FC0511"""
    return F.concat(quarter_code(day), F.lit("FC"), F.date_format(_col(day), "MMdd"))


def forecast_code_to_date(code: str | Column) -> Column:
    """26Q2FC0511 -> 2026-05-11; the quarter digit is not read."""
    code = _col(code)
    return F.make_date(F.substring(code, 1, 2).cast("int") + 2000,
                       F.substring(code, -4, 2).cast("int"),
                       F.substring(code, -2, 2).cast("int"))


def refresh_due(last_load: str | Column, today: str | Column, frequency: str) -> Column:
    """True when ``today`` lies in a later period than the last load, or nothing was loaded."""
    last_load, today = _col(last_load), _col(today)
    if frequency == "daily":
        later = last_load < today
    elif frequency in FREQUENCY_MONTHS:
        months = FREQUENCY_MONTHS[frequency]

        def period(day: Column) -> Column:
            return F.floor((F.year(day) * 12 + F.month(day) - 1) / months)

        later = period(last_load) < period(today)
    else:
        raise ValueError(f"Unknown refresh frequency: {frequency}")
    return last_load.isNull() | later
