"""Key cleaning and safe conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(col: str | Column) -> Column:
    """Lower case, outer blanks removed, inner runs of blanks reduced to one."""
    return F.lower(F.trim(F.regexp_replace(col, r"\s+", " ")))


def clean_code(col: str | Column) -> Column:
    """Upper case without outer blanks."""
    return F.upper(F.trim(col))


def concat_key(*cols: str | Column, sep: str = "") -> Column:
    """Parts joined by ``sep``; null as soon as one part is null."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return reduce(lambda left, right: F.concat(left, F.lit(sep), right), parts)


def recode(col: str | Column, codes: dict[str, str]) -> Column:
    """Replace the listed codes, leave every other value (and null) as it is."""
    col = F.col(col) if isinstance(col, str) else col
    if not codes:
        return col
    chosen = F
    for old, new in codes.items():
        chosen = chosen.when(col == old, F.lit(new))
    return chosen.otherwise(col)


def classify(col: str | Column, classes: dict[str, list[str]]) -> Column:
    """Class whose code list holds the value; null when no list does."""
    col = F.col(col) if isinstance(col, str) else col
    chosen = F
    for name, codes in classes.items():
        chosen = chosen.when(col.isin(codes), F.lit(name))
    return chosen.otherwise(F.lit(None).cast("string"))


def classify_rules(rules: list[tuple[str | Column, str]], default: str) -> Column:
    """First rule that holds decides; ``default`` when none does. Rules may be SQL text."""
    chosen = F
    for condition, name in rules:
        holds = F.expr(condition) if isinstance(condition, str) else condition
        chosen = chosen.when(holds, F.lit(name))
    return chosen.otherwise(F.lit(default))


def parse_date(col: str, dtype: str, fmt: str) -> Column:
    """Date from a date or timestamp column, else from text; null where text does not parse."""
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return F.col(col).cast("date")
    return F.try_to_date(F.col(col), fmt)
