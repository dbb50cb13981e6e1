"""Exposures and shocks built from the synthetic tables.

Exposure is the extended price of line items by market segment, currency (region number)
and tenor (priority digit, in years). A scenario is a user of the events table, its shock
at a tenor the greatest value of the event type that stands for the tenor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import from_units, units
from curvemill.operators.curves import present_masks
from curvemill.operators.scenarios import shock_rows
from curvemill.staging import Staged, stage
from curvemill.standin.registry import Tables

TENORS = [12, 24, 36, 48, 60]
EVENT_TENORS = {"click": 12, "error": 24, "purchase": 36, "signup": 48, "view": 60}

EXPOSURE_SQL = """
exposure AS (
  SELECT c_mktsegment AS segment, CAST(n_regionkey AS INTEGER) AS currency,
         12 * CAST(left(o_orderpriority, 1) AS INTEGER) AS tenor,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""

SHOCK_SQL = """
shock AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS currency, user_id AS scenario,
         CASE event_type WHEN 'click' THEN 12 WHEN 'error' THEN 24 WHEN 'purchase' THEN 36
              WHEN 'signup' THEN 48 WHEN 'view' THEN 60 END AS tenor,
         max(value) AS shock
  FROM events GROUP BY ALL)"""


def per_customer(t: Tables, cells: dict[str, str], tenors: list[int]) -> DataFrame:
    """Cents of line items per customer, one column per cell and tenor of the order.

    ``cells`` maps a prefix to the condition (SQL text) of the line items it sums.

    Line items are summed per order and orders per customer before each join, so every
    join has one row per key on both sides and the hottest key costs one row per task.
    """
    lines = t.lineitem.groupBy("l_orderkey").agg(
        *[F.sum(F.when(F.expr(on), units("l_extendedprice"))).alias(n)
          for n, on in cells.items()])
    orders = t.orders.select(
        "o_orderkey", "o_custkey",
        (F.substring("o_orderpriority", 1, 1).cast("int") * 12).alias("tenor"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")) \
        .groupBy("o_custkey").agg(*[
            F.expr(f"sum(case when tenor = {m} then {n} end) as {n}{m}")
            for n in cells for m in tenors])


def customers(t: Tables) -> DataFrame:
    """Customer with segment, nation and region number."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("c_mktsegment").alias("segment"),
        F.col("n_regionkey").alias("currency"), "n_nationkey")


def region_names(df: DataFrame, t: Tables) -> DataFrame:
    """Region name for the region number of rows that are already summed."""
    return df.join(t.region, F.col("currency") == F.col("r_regionkey")).drop("r_regionkey")


def exposure_rows(t: Tables, keys: list[str]) -> DataFrame:
    """Curve rows of the whole book: one aggregate per grain, exact until the last cast."""
    sums = per_customer(t, {"e": "true"}, TENORS)
    return (sums.join(customers(t), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(*keys)
            .agg(*[from_units(F.sum(f"e{m}")).alias(f"e{m}") for m in TENORS]))


def with_mask(rows: DataFrame) -> DataFrame:
    return rows.withColumns(present_masks(TENORS, "e"))


def staged_exposure(t: Tables, keys: tuple[str, ...] = ("segment", "currency")) -> Staged:
    return stage(with_mask(exposure_rows(t, list(keys))), "exposure")


def event_tenor() -> Column:
    tenor = F
    for name, months in EVENT_TENORS.items():
        tenor = tenor.when(F.col("event_type") == name, F.lit(months))
    return tenor


def shock_points(t: Tables) -> DataFrame:
    """Every event as a shock; the greatest per point counts."""
    return t.events.select((F.col("user_id") % 5).cast("int").alias("currency"),
                           F.col("user_id").alias("scenario"),
                           event_tenor().alias("tenor"), F.col("value").alias("shock"))


def scenario_table(t: Tables, points: DataFrame | None = None) -> DataFrame:
    return shock_rows(shock_points(t) if points is None else points, ["currency"],
                      "scenario", "tenor", "shock", TENORS)
