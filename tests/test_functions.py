import calendar
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from curvemill.functions import amounts, calendar as cal, keys

START = date(2023, 12, 1)
DAYS = [START + timedelta(days=i) for i in range(900)]


def month_end(year, month):
    return date(year, month, calendar.monthrange(year, month)[1])


@pytest.fixture(scope="module")
def days(rows):
    return rows([(d,) for d in DAYS], "day date")


def test_month_and_quarter_ends(days):
    found = days.select("day", cal.last_month_end("day"), cal.last_quarter_end("day"),
                        cal.quarter_end("day"), cal.next_month_start("day")).collect()
    for day, last_month, last_quarter, quarter, following in found:
        assert last_month == day.replace(day=1) - timedelta(days=1)
        first = date(day.year, (day.month - 1) // 3 * 3 + 1, 1)
        assert last_quarter == first - timedelta(days=1)
        assert quarter == month_end(day.year, first.month + 2)
        assert following == month_end(day.year, day.month) + timedelta(days=1)


def test_weekend_flags(days):
    for day, weekend, business in days.select(
            "day", cal.is_weekend("day"), cal.is_business_day("day")).collect():
        assert weekend == (day.weekday() >= 5) and business == (not weekend)


@pytest.mark.parametrize("n", [1, 2, 5, 13, 22, 40])
def test_nth_business_date_counts_from_the_second(days, n):
    for day, found in days.select("day", cal.nth_business_date("day", n)).collect():
        expected, left = day.replace(day=1), n
        while left:
            expected += timedelta(days=1)
            left -= expected.weekday() < 5
        assert found == expected


def test_first_business_date_of_a_month_that_starts_on_monday(rows):
    df = rows([(date(2026, 6, 20),)], "day date")
    assert df.select(cal.nth_business_date("day", 1)).first()[0] == date(2026, 6, 2)


def test_nth_business_date_rejects_zero(rows):
    with pytest.raises(ValueError):
        cal.nth_business_date("day", 0)
    df = rows([(date(2026, 6, 1), 0)], "day date, n int")
    with pytest.raises(Exception, match="n must be positive"):
        df.select(cal.nth_business_date("day", F.col("n"))).collect()


def test_codes(rows):
    df = rows([(date(2026, 5, 11),)], "day date")
    quarter, forecast = df.select(cal.quarter_code("day"), cal.forecast_code("day")).first()
    assert (quarter, forecast) == ("26Q2", "26Q2FC0511")
    back = rows([("26Q2", "26Q4FC0511", "20260511")], "q string, f string, t string").select(
        cal.quarter_code_to_date("q"), cal.forecast_code_to_date("f"), cal.text_to_date("t"))
    assert tuple(back.first()) == (date(2026, 6, 30), date(2026, 5, 11), date(2026, 5, 11))


def test_wrong_quarter_code_fails(rows):
    with pytest.raises(Exception, match="invalid quarter code: 26Q5"):
        rows([("26Q5",)], "q string").select(cal.quarter_code_to_date("q")).collect()


def test_report_date(rows):
    df = rows([(date(2026, 5, 1),)], "day date")
    assert df.select(cal.report_date("day")).first()[0] == date(2026, 4, 30)


def test_refresh_due(rows):
    df = rows([(date(2026, 3, 31), date(2026, 4, 1)), (None, date(2026, 4, 1)),
               (date(2026, 4, 1), date(2026, 4, 1))], "last date, today date")

    def due(frequency):
        return [r[0] for r in df.select(cal.refresh_due("last", "today", frequency)).collect()]

    assert due("daily") == due("monthly") == due("quarterly") == [True, True, False]
    assert due("semi-annually") == due("annually") == [False, True, False]
    with pytest.raises(ValueError):
        cal.refresh_due("last", "today", "hourly")


def test_key_functions(rows):
    df = rows([("  Mixed \t Case ", "A")], "a string, b string")
    got = df.select(keys.normalize_text("a"), keys.clean_code("a"),
                    keys.concat_key("b", "b"), keys.concat_key("b", F.lit(None)),
                    keys.recode("b", {"A": "Z"}), keys.recode("b", {"Q": "Z"}),
                    keys.classify("b", {"first": ["A", "C"]}),
                    keys.classify("b", {"first": ["C"]}),
                    keys.classify_rules([("b = 'A'", "one"), ("true", "two")], "x")).first()
    assert tuple(got) == ("mixed case", "MIXED \t CASE", "AA", None, "Z", "A", "first", None,
                          "one")


def test_parse_date_by_type(rows):
    text = rows([("31-Aug-26",), ("bad",)], "d string")
    assert [r[0] for r in text.select(keys.parse_date("d", "string", "dd-MMM-yy")).collect()] \
        == [date(2026, 8, 31), None]
    real = rows([(date(2026, 8, 31),)], "d date")
    assert real.select(keys.parse_date("d", "date", "dd-MMM-yy")).first()[0] \
        == date(2026, 8, 31)


def test_rates_and_net_amounts(rows):
    df = rows([("BASE", 1000.0, None, 0.2), ("USD", 1000.0, 0.5, 0.2),
               ("JPY", 1000.0, None, 0.2)], "ccy string, total double, fx double, tax double")
    fx = amounts.base_rate("fx", "ccy", "BASE")
    assert [r[0] for r in df.select(amounts.net_amount("total", fx, "tax")).collect()] \
        == [800.0, 400.0, None]
    assert df.select(amounts.post_tax(F.lit(5_000_000.0), "tax")).first()[0] == 4.0


def test_exact_total_does_not_depend_on_order(spark):
    df = spark.range(20000).select((F.col("id") % 1000 / 100 + 0.1).alias("v"), "id")
    sums = {df.repartition(n).agg(amounts.total("v", 2)).first()[0] for n in (1, 3, 7, 8)}
    assert sums == {(sum(i % 1000 + 10 for i in range(20000))) / 100}


def test_amounts_beyond_their_scale_fail(rows):
    df = rows([(0.1,), (0.25,), (None,), (123456789012.35,)], "x double")
    assert [r.u for r in df.select(amounts.units("x", 2).alias("u")).collect()] == [
        10, 25, None, 12345678901235]
    with pytest.raises(Exception, match="more than 2 decimals"):
        rows([(0.004,)], "x double").select(amounts.total("x", 2).alias("u")).collect()
