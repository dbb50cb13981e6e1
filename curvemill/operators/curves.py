"""Curves: wide tenor columns, long curves and curve rows.

A *curve row* holds one key and one column per declared tenor (prefix + months), with a
bit mask of the tenors that exist. Tenors are whole months, in any number: a mask takes one
column per 63 of them (``emask``, ``emask_1``, ...). Curve rows let a sum-product over tenors be an expression inside one row: scenario tables are
neither multiplied by the number of tenors nor aggregated again, and sums run in tenor
order, so that doubles come out the same on every run.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import total, zero_if_null

# Fixed value: a tenor column is named by its months, such as 003M.
TENOR_PATTERN = r"(\d+)M"
MASK_BITS = 63


def tenor_columns(df: DataFrame, pattern: str = TENOR_PATTERN) -> dict[int, str]:
    """Months -> column name of the tenor columns; fails when there is none."""
    found = {int(m.group(1)): c for c in df.columns if (m := re.fullmatch(pattern, c))}
    if not found:
        raise ValueError(f"No tenor columns matching {pattern} found in: {df.columns}")
    return dict(sorted(found.items()))


def tenor_months(years: str | Column) -> Column:
    """Tenor in years (any number type) as whole months, the join key for tenors."""
    return F.round(F.col(years) * 12 if isinstance(years, str) else years * 12).cast("int")


def unpivot_curve(df: DataFrame, keys: list[str], tenor: str = "tenor_years",
                  value: str = "value", pattern: str = TENOR_PATTERN) -> DataFrame:
    """Wide tenor columns to rows of (keys, tenor in years, value); null values stay."""
    columns = tenor_columns(df, pattern)
    plain = df.select(*keys, *[
        F.col(f"`{c}`").try_cast("double").alias(str(m)) for m, c in columns.items()])
    rows = plain.unpivot(keys, [F.col(f"`{m}`") for m in columns], "_months", value)
    return rows.select(*keys, (F.col("_months").cast("int") / F.lit(12)).alias(tenor), value)


def curve_totals(df: DataFrame, keys: list[str], value: str, name: str,
                 scale: int | None = None) -> DataFrame:
    """Sum per curve point (``keys`` include the tenor); exact up to ``scale`` decimals."""
    return df.groupBy(*keys).agg(total(value, scale).alias(name))


def check_tenors(tenors: list[int]) -> list[int]:
    if not tenors:
        raise ValueError("A curve needs at least one tenor")
    return sorted(set(tenors))


def mask_names(mask: str, tenors: list[int]) -> list[str]:
    """The columns of a mask over these tenors."""
    return [mask if i == 0 else f"{mask}_{i}" for i in range(-(-len(tenors) // MASK_BITS))]


def mask_columns(df: DataFrame, mask: str) -> list[str]:
    """The columns of a mask that ``df`` holds."""
    found = [mask]
    while f"{mask}_{len(found)}" in df.columns:
        found.append(f"{mask}_{len(found)}")
    return found


def _bit(i: int) -> tuple[int, int]:
    """Number of the mask column and value of the bit of the i-th tenor."""
    return i // MASK_BITS, 1 << i % MASK_BITS


def curve_rows(df: DataFrame, keys: list[str], tenor: str, value: str, tenors: list[int],
               prefix: str, combine: str = "sum", strict: bool = True) -> DataFrame:
    """Long curve to curve rows: one aggregate, one shuffle, reduced on the map side.

    ``value`` is a column or SQL text, ``combine`` the aggregate for repeated points. With
    ``strict`` a tenor that is not declared fails the query rather than being left out;
    without it such tenors are ignored, which suits the table that is matched against a
    strict one. Null tenors match nothing and are left out.
    """
    tenors = check_tenors(tenors)
    cells = [F.expr(f"double({combine}(case when {tenor} = {m} then {value} end)) "
                    f"as {prefix}{m}") for m in tenors]
    masks = [F.expr(existing_tenors(tenor, tenors, strict and i == 0, i)).alias(name)
             for i, name in enumerate(mask_names(f"{prefix}mask", tenors))]
    return df.groupBy(*keys).agg(*cells, *masks)


def existing_tenors(tenor: str, tenors: list[int], strict: bool, column: int = 0) -> str:
    """Aggregate (SQL text): one bit per declared tenor that occurs in the group, for the
    tenors of one mask column."""
    places = {m: _bit(i) for i, m in enumerate(tenors)}
    bits = " ".join(f"when {m} then {bit if at == column else 0}L"
                    for m, (at, bit) in places.items())
    other = (f"else if({tenor} is null, null, bigint(raise_error("
             f"concat('tenor is not declared: ', {tenor}))))") if strict else ""
    return f"coalesce(bit_or(case {tenor} {bits} {other} end), 0L)"


def wide_curve_rows(df: DataFrame, keys: list[str], prefix: str, scale: int | None = None,
                    pattern: str = TENOR_PATTERN) -> tuple[DataFrame, list[int]]:
    """Wide feeds summed per key into curve rows, and the tenors found.

    A null cell counts as zero where the feed has the column. A tenor that no feed of a
    key delivers stays absent.
    """
    columns = tenor_columns(df, pattern)
    cells = [total(F.col(f"`{c}`").try_cast("double"), scale).alias(f"{prefix}{m}")
             for m, c in columns.items()]
    totals = df.groupBy(*keys).agg(*cells)
    tenors = check_tenors(list(columns))
    return totals.withColumns(present_masks(tenors, prefix)), tenors


def zero_tenors(df: DataFrame, pattern: str = TENOR_PATTERN) -> DataFrame:
    """A wide feed with zeros for the nulls in its own tenor columns."""
    return df.withColumns({c: zero_if_null(F.col(f"`{c}`").try_cast("double"))
                           for c in tenor_columns(df, pattern).values()})


def present_masks(tenors: list[int], prefix: str) -> dict[str, Column]:
    """The columns of a mask with a bit per tenor whose cell is not null."""
    places = {m: _bit(i) for i, m in enumerate(check_tenors(tenors))}
    return {name: F.expr(" | ".join(f"if({prefix}{m} is null, 0L, {bit}L)"
                                    for m, (at, bit) in places.items() if at == i))
            for i, name in enumerate(mask_names(f"{prefix}mask", list(places)))}


def curve_points(df: DataFrame, keys: list[str], tenors: list[int], mask: str, tenor: str,
                 values: dict[str, str]) -> DataFrame:
    """Curve rows back to a long curve with the tenors that exist, in years.

    ``values`` maps each prefix to the name its values get in the long curve.
    """
    tenors = check_tenors(tenors)
    names = mask_names(mask, tenors)
    plain = df.select(*keys, *[
        F.expr("if(({} & {}L) = 0, null, struct({})) as `{}`".format(
            names[at], bit, ", ".join(f"{p}{m} as {v}" for p, v in values.items()), m))
        for m, (at, bit) in ((m, _bit(i)) for i, m in enumerate(tenors))])
    rows = plain.unpivot(keys, [f"`{m}`" for m in tenors], "_months", "_point")
    return rows.where("_point is not null").select(
        *keys, F.expr(f"int(_months) / 12 as {tenor}"), "_point.*")


def missing_tenors(exposure: DataFrame, shocks: DataFrame, curve: list[str],
                   tenors: list[int], masks: tuple[str, str] = ("emask", "smask"),
                   name: str = "tenors") -> DataFrame:
    """Sorted tenors (months) per curve that have exposure but no shock in any scenario.

    Works on the masks of curve rows, so nothing is unpivoted.
    """
    tenors = check_tenors(tenors)
    wanted_names, known_names = (mask_names(m, tenors) for m in masks)
    wanted = exposure.groupBy(*curve).agg(
        *[F.bit_or(c).alias(f"_wanted{i}") for i, c in enumerate(wanted_names)])
    known = shocks.groupBy(*curve).agg(
        *[F.bit_or(c).alias(f"_known{i}") for i, c in enumerate(known_names)])
    lost = [F.col(f"_wanted{i}").bitwiseAND(
        F.bitwise_not(F.coalesce(f"_known{i}", F.lit(0).cast("bigint")))).alias(f"_lost{i}")
        for i in range(len(wanted_names))]
    listed = F.expr("array_compact(array({}))".format(", ".join(
        f"if((_lost{at} & {bit}L) = 0, null, {m})"
        for m, (at, bit) in ((m, _bit(i)) for i, m in enumerate(tenors)))))
    some = " or ".join(f"_lost{i} != 0" for i in range(len(lost)))
    return (wanted.join(known, curve, "left").select(*curve, *lost)
            .where(some).select(*curve, listed.alias(name)))


def tail_average(tenors: list[int], prefix: str, last: int) -> Column:
    """Mean over the ``last`` longest tenors that hold a value, within a curve row."""
    cells = ", ".join(f"{prefix}{m}" for m in sorted(tenors, reverse=True))
    tail = F.expr(f"slice(array_compact(array({cells})), 1, {last})")
    total = F.aggregate(tail, F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(tail) > 0, total / F.size(tail))
