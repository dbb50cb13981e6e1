"""Lookups: newest row per key, rates by date, enrichment by left joins.

Dimensions from files or literals carry no broadcast hint: Spark knows their size,
broadcasts below its threshold and otherwise shuffles, with the skew handling of adaptive
execution. A dimension computed from a large table is staged first; its counted rows
decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.keys import clean_code, normalize_text, parse_date
from curvemill.staging import Staged, stage


def newest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the one with the greatest ``order``, then the greatest row.

    An aggregate with a total order: it reduces before the shuffle, so a key with many
    rows costs one row per map task, and the pick never depends on the order of rows.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)],
                    *[F.col(c).alias(f"_row_{c}") for c in rest])
    newest = df.groupBy(*keys).agg(F.max(rank).alias("_newest"))
    return newest.select(*[
        F.col(c) if c in keys else F.col(f"_newest._row_{c}").alias(c) for c in df.columns])


def newest_with_ties(df: DataFrame, keys: list[str | Column], order: str) -> DataFrame:
    """All rows that carry the newest ``order`` of their key (dense rank 1).

    The newest value per key is an aggregate joined back, not a window over all rows of
    a key: a join may broadcast the few newest values or split a hot key, a window cannot.
    The aggregate is staged, so that its counted rows decide about the broadcast.
    """
    keyed = df.withColumns({
        f"_key{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)})
    names = [f"_key{i}" for i in range(len(keys))]
    newest = keyed.groupBy(*names).agg(F.max(order).alias("_newest"))
    newest = newest.toDF(*[f"_of{n}" for n in names], "_newest")
    staged = stage(newest, "newest")
    newest = F.broadcast(staged.df) if staged.fits() else staged.df
    same = [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names]
    same.append(F.col(order).eqNullSafe(F.col("_newest")))
    return keyed.join(newest, same, "left_semi").select(*df.columns)


def lookup(df: DataFrame, dimension: DataFrame | Staged, keys: dict[str, str | Column],
           columns: list[str]) -> DataFrame:
    """Left join that adds ``columns`` of a dimension; unmatched rows keep nulls.

    ``keys`` maps each key column of the dimension to the column or expression of ``df``
    it must equal.
    """
    table = dimension.df if isinstance(dimension, Staged) else dimension
    side = table.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *columns)
    if isinstance(dimension, Staged) and dimension.fits():
        side = F.broadcast(side)
    same = [(F.col(v) if isinstance(v, str) else v) == F.col(f"_key_{k}")
            for k, v in keys.items()]
    return df.join(side, same, "left").select(*df.columns, *columns)


def tax_by_portfolio(hierarchy: DataFrame, name: str, date_key: str, tax: str) -> DataFrame:
    """One tax rate per normalised portfolio name, from the newest date key."""
    rows = hierarchy.select(normalize_text(name).alias("portfolio_key"), F.col(date_key),
                            F.col(tax).try_cast("double").alias("tax_rate"))
    return newest_per_key(rows, ["portfolio_key"], [date_key]).drop(date_key)


def rates_by_currency(rates: DataFrame, currency: str, rate: str) -> DataFrame:
    """One rate per currency, for rates of a single date; the greatest where several exist."""
    rows = rates.select(clean_code(currency).alias("fx_currency"),
                        F.col(rate).try_cast("double").alias("fx_rate"))
    return rows.groupBy("fx_currency").agg(F.max("fx_rate").alias("fx_rate"))


def unparsed_dates(df: DataFrame, day: str, fmt: str, count: str = "rows") -> DataFrame:
    """Values of a date column that cannot be read, with their number of rows."""
    parsed = parse_date(day, df.select(day).dtypes[0][1], fmt)
    return df.where(F.col(day).isNotNull() & parsed.isNull()).groupBy(day).agg(
        F.count(F.lit(1)).alias(count))


def rates_by_date(rates: DataFrame, currency: str, rate: str, day: str, fmt: str,
                  load_stamp: str) -> DataFrame:
    """One rate per currency and date: the newest load wins, unparsed dates are dropped."""
    rows = rates.select(
        clean_code(currency).alias("fx_currency"),
        parse_date(day, rates.select(day).dtypes[0][1], fmt).alias("fx_date"),
        F.col(rate).try_cast("double").alias("fx_rate"), F.col(load_stamp).alias("_stamp"))
    rows = rows.where("fx_date is not null")
    return newest_per_key(rows, ["fx_currency", "fx_date"], ["_stamp"]).drop("_stamp")
