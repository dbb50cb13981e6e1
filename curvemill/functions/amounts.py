"""Amounts, rates and the formulas over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(col: str | Column, scale: int = 2) -> Column:
    """Amount as a whole number of its smallest unit (cents for two decimals).

    An amount with more decimals fails the query rather than being rounded; only what a
    double cannot hold of a decimal fraction is forgiven.
    """
    col = F.col(col) if isinstance(col, str) else col
    exact = col * 10**scale
    off = F.abs(exact - F.rint(exact)) > F.greatest(F.lit(1e-6), F.abs(exact) * 1e-14)
    return F.when(off, F.raise_error(F.concat(
        F.lit(f"more than {scale} decimals: "), col.cast("string"))).cast("bigint")) \
        .otherwise(F.rint(exact).cast("bigint"))


def from_units(col: str | Column, scale: int = 2) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col / F.lit(float(10**scale))


def total(col: str | Column, scale: int | None = None) -> Column:
    """Sum of an amount as a double.

    With a scale the sum runs over whole units: it does not depend on the order of rows,
    costs no more than a plain sum (decimals cost ten times as much), and a sum beyond 64
    bits fails in ANSI mode instead of losing digits.
    """
    if scale is None:
        return F.sum(col).cast("double")
    return from_units(F.sum(units(col, scale)), scale)


def zero_if_null(col: str | Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def base_rate(rate: str | Column, currency: str | Column, base) -> Column:
    """Rate 1 for the base currency without a rate; other missing rates stay null."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    currency = F.col(currency) if isinstance(currency, str) else currency
    return F.when(rate.isNull() & (currency == F.lit(base)), F.lit(1.0)).otherwise(rate)


def net_amount(total: str | Column, rate: str | Column, tax: str | Column) -> Column:
    """total x rate x (1 - tax); null when a factor is null."""
    total, rate, tax = (F.col(c) if isinstance(c, str) else c for c in (total, rate, tax))
    return total * rate * (1 - tax)


def post_tax(amount: str | Column, tax: str | Column, unit: float = 1_000_000) -> Column:
    """amount x (1 - tax), expressed in ``unit``."""
    amount, tax = (F.col(c) if isinstance(c, str) else c for c in (amount, tax))
    return amount * (1 - tax) / unit
