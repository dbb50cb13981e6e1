"""As-of joins: the newest row that is not later than a date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.calendar import quarter_end
from curvemill.operators.shaping import forward_fill
from curvemill.staging import stage


def by_month(day: Column) -> Column:
    """Consecutive numbers of months, the pieces that dates and timestamps are cut into."""
    return F.year(day) * 12 + F.month(day)


def as_of_join(df: DataFrame, table: DataFrame, keys: list[str], at: str, since: str,
               columns: list[str], newest: list[str | Column] | None = None,
               piece: Callable[[Column], Column] = by_month) -> DataFrame:
    """Left join that adds, per row of ``df``, ``columns`` of one row of ``table``.

    It is the row with equal ``keys`` whose ``since`` is the greatest that is not beyond ``at``.
    Of several rows with that ``since`` the one with the greatest ``newest`` counts, then the
    greatest row; its columns may be null. Rows with a null key or a null ``at`` find nothing,
    rows of the table with a null key or ``since`` are never found. ``columns`` may contain
    ``since``; a name that ``df`` has already needs renaming first.

    Both sides are reduced to one row per key and moment before they meet, so rows that share
    both (a third of all rows, say) cost one. The moments of a key are cut into pieces by
    ``piece``, which must not fall as time goes on; each piece hands the next ones one row, see
    ``forward_fill``. What is found joins the rows of ``df`` by key and moment.
    """
    kinds = dict(df.dtypes)[at], dict(table.dtypes)[since]
    if kinds[0] != kinds[1]:
        raise ValueError(f"{at} is a {kinds[0]}, {since} a {kinds[1]}: cast one of them")
    names = [f"_k{i}" for i in range(len(keys))]
    order = [F.col(c) if isinstance(c, str) else c for c in newest or []]
    rank = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)],
                    F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)]).alias("_row"))

    def moments_of(side: DataFrame, moment: str, *more: Column) -> DataFrame:
        named = [F.col(k).alias(n) for k, n in zip(keys, names)]
        return side.select(*named, F.col(moment).alias("_at"), *more).dropna(subset=[*names, "_at"])

    given = moments_of(table, since, rank.alias("_rank")).groupBy(*names, "_at").agg(
        F.max("_rank").alias("_rank"))
    asked = moments_of(df, at).distinct().withColumn(
        "_rank", F.lit(None).cast(given.schema["_rank"].dataType))
    moments = given.withColumn("_side", F.lit(0)).unionByName(asked.withColumn("_side", F.lit(1)))
    filled = forward_fill(moments, ["_rank"], ["_at", "_side"], piece(F.col("_at")), names)
    found = filled.where("_side = 1 and _rank is not null").select(
        *names, "_at", *[F.col(f"_rank._row.v{i}").alias(f"_v{i}") for i in range(len(columns))])
    side = stage(found, "as-of")
    right = F.broadcast(side.df) if side.fits() else side.df
    same = [F.col(k) == F.col(n) for k, n in zip(keys, names)] + [F.col(at) == F.col("_at")]
    return df.join(right, same, "left").select(
        *df.columns, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(columns)])


def shock_set_as_of(dates: DataFrame, sets: DataFrame, day: str, effective: str) -> DataFrame:
    """Add to each day the effective date of its shock set, for any number of sets on file.

    The set of the quarter that holds the day, else the newest one that is not later. No list of
    the sets is built: the quarter is a join on equality, the rest an as-of join.
    """
    on_file = sets.select(F.col(effective).cast("date").alias("_set")).where("_set is not null").distinct()
    held = dates.withColumn("_quarter", quarter_end(day)).join(
        on_file.withColumnRenamed("_set", "_held"), F.col("_quarter") == F.col("_held"), "left")
    found = as_of_join(held, on_file, [], day, "_set", ["_set"])
    return found.select(*dates.columns, F.coalesce("_held", "_set").alias(effective))
