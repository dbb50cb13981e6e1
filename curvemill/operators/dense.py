"""Dense curves: the tenors of a curve as one array, for curves of any number of tenors.

Curve rows with a column per tenor leave generated code beyond 100 columns. A dense row has one
array of values and one array of bit masks per class instead, so a join of rows with hundreds
of tenors stays one generated stage. The product of two rows is worked off in runs of tenors,
each a projection on top of the last, which keeps every generated method small; sums run in
tenor order.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import total
from curvemill.operators.curves import check_tenors
from curvemill.sources.snapshots import literal_rows
from curvemill.staging import BROADCAST_ROWS, Staged, join_small

WIDTH = 60      # tenors of a block: one aggregate column each, and the bits of a mask
TERMS = 18      # products in one projection, over all curves


def dense_rows(points: DataFrame, keys: list[str], tenor: str, value: str, tenors: list[int],
               prefix: str, combine: str = "sum", scale: int | None = None,
               classes: tuple[str, list] | None = None, strict: bool = True) -> DataFrame:
    """Long curve points to one dense row per key.

    A curve is ``{prefix}`` (array of doubles in tenor order, null where there is no point) and
    ``{prefix}mask`` (bits of the tenors that exist). ``combine`` is the aggregate of repeated
    points; sums with a ``scale`` run over whole units. ``classes`` (column, values) gives a
    curve ``{prefix}0``, ``{prefix}1``, ... per value; a key without any of them still gets a
    row. With ``strict`` a tenor that is not declared fails the query, else it is left out.

    Points are reduced twice, each time on the map side first: to blocks of ``WIDTH`` tenors,
    then to the blocks of a key, whose number the tenors and classes give.
    """
    tenors = check_tenors(tenors)
    size = len(tenors)
    per_curve = -(-size // WIDTH)
    names = [f"{prefix}{i}" for i in range(len(classes[1]))] if classes else [prefix]
    place = literal_rows(points.sparkSession, [(m, i) for i, m in enumerate(tenors)],
                         "_tenor int, _place int")
    placed = points.where(F.col(tenor).isNotNull()).join(
        place, F.col(tenor) == F.col("_tenor"), "left")
    if strict:
        undeclared = F.raise_error(F.concat(F.lit("tenor is not declared: "), F.col(tenor).cast("string")))
        placed = placed.withColumn("_place", F.coalesce("_place", undeclared.cast("int")))
    curve = F.lit(0)
    if classes:
        column, values = classes
        curve = reduce(lambda c, i: c.when(F.col(column) == values[i], F.lit(i)), range(len(values)), F)
    placed = placed.withColumns({
        "_block": curve * per_curve + F.floor(F.col("_place") / WIDTH).cast("int"),
        "_at": F.col("_place") % WIDTH})
    cells = []
    for i in range(min(WIDTH, size)):
        cell = F.when(F.col("_at") == i, F.col(value))
        cells.append(total(cell, scale) if combine == "sum" else F.expr(f"{combine}(_v{i})").cast("double"))
        if combine != "sum":
            placed = placed.withColumn(f"_v{i}", cell)
    exists = F.bit_or(F.when(F.col(value).isNotNull(), F.expr("shiftleft(1L, _at)")))
    blocks = placed.groupBy(*keys, "_block").agg(
        *[c.alias(f"_c{i}") for i, c in enumerate(cells)], F.coalesce(exists, F.lit(0)).alias("_bits"))
    blocks = blocks.select(*keys, F.struct("_block", "_bits", F.array(
        *[F.col(f"_c{i}") for i in range(len(cells))]).alias("_values")).alias("_b"))
    rows = blocks.groupBy(*keys).agg(F.collect_list(F.when(
        F.col("_b._block").isNotNull(), F.col("_b"))).alias("_bs")).withColumn(
        "_bs", F.map_from_entries(F.transform("_bs", lambda b: F.struct(b["_block"], b))))
    nothing = F.array(*[F.lit(None).cast("double")] * len(cells))
    out = []
    for c, name in enumerate(names):
        found = [F.try_element_at("_bs", F.lit(c * per_curve + k)) for k in range(per_curve)]
        values = F.flatten(F.array(*[F.coalesce(b["_values"], nothing) for b in found]))
        out += [(F.slice(values, 1, size) if per_curve * len(cells) != size else values).alias(name),
                F.array(*[F.coalesce(b["_bits"], F.lit(0)) for b in found]).alias(f"{name}mask")]
    return rows.select(*keys, *out)


def _common(left: str, right: str, words: int) -> Column:
    """Number of tenors that both curves have."""
    return F.expr(" + ".join(f"bit_count({left}mask[{w}] & {right}mask[{w}])" for w in range(words))) \
        .cast("bigint")


def dense_product(pairs: DataFrame, curves: Mapping[str, tuple[str, str]], tenors: int,
                  keep: list[str]) -> DataFrame:
    """``keep`` with the sum over tenors of left x right per name of ``curves``; null without one.

    Each run of tenors is a projection that adds to the sums of the last. Every column of a run
    is used at least twice in the next one, which has two effects: Catalyst does not fold the
    runs into one expression, and each run becomes a generated method of its own, small enough
    for the JVM to compile, while all of them stay in one stage with the join.
    """
    words = -(-tenors // WIDTH)
    arrays = sorted({a for pair in curves.values() for a in pair})
    counts = [_common(a, b, words).alias(n) for n, (a, b) in curves.items()]
    pairs = pairs.select(F.struct(F.struct(*keep).alias("keep"), *counts).alias("_row"), *arrays,
                         *[F.lit(None).cast("double").alias(n) for n in curves])
    size = max(1, TERMS // len(curves))
    for at in range(0, tenors, size):
        run = range(at, min(at + size, tenors))
        sums = [F.expr(f"if(_row.`{n}` > 0, if(`{n}` is null, 0.0D, `{n}`) + " + " + ".join(
            f"coalesce(get(`{a}`, {i}) * get(`{b}`, {i}), 0.0D)" for i in run) + ", null)").alias(n)
            for n, (a, b) in curves.items()]
        pairs = pairs.select("_row", *arrays, *sums)
    return pairs.select("_row.keep.*", *curves, *[F.col(f"_row.`{n}`").alias(f"{n}_tenors")
                                                  for n in curves])


def dense_losses(exposure: Staged, shocks: DataFrame, *, keys: list[str], curve: list[str],
                 scenario: str, tenors: int, losses: Mapping[str, str], shock: str = "s",
                 multiplier: float = 1.0, divisor: float = 1.0,
                 limit: int = BROADCAST_ROWS) -> DataFrame:
    """Losses per exposure key and scenario, one column and one tenor count per curve.

    ``losses`` maps the name of a loss to the exposure curve it is taken from (a class, or the
    only curve). A pair that shares no tenor in any of them gives no row.
    """
    pairs = join_small(shocks, exposure, curve, limit)
    words = -(-tenors // WIDTH)
    some = reduce(lambda a, b: a | b, [_common(e, shock, words) > 0 for e in losses.values()])
    found = dense_product(pairs.where(some), {n: (e, shock) for n, e in losses.items()}, tenors,
                          [*keys, scenario])
    return found.withColumns({n: F.col(n) * multiplier / divisor for n in losses})
