"""Losses of the unhedged book: first order, gamma, second order and their total.

The small side of every many-to-many join is staged and checked before it is broadcast.
Totals can be had in two equal ways: ``total_losses`` joins two stored loss tables, and
``combined_losses`` computes both orders in one pass over the scenarios.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import post_tax, total
from curvemill.functions.keys import classify_rules, concat_key, normalize_text, recode
from curvemill.operators import scenarios
from curvemill.operators.curves import curve_rows, tenor_months
from curvemill.operators.quality import duplicate_keys
from curvemill.operators.scenarios import (
    pair_scenarios, parallel_gamma, scenario_losses, second_order, shock_rows,
    sum_product, with_quantile)
from curvemill.sources.sinks import write_bucketed
from curvemill.sources.snapshots import latest_snapshot
from curvemill.staging import BROADCAST_ROWS, Staged, stage

# Key columns of the loss tables.
GROUP = ["market", "segment_name", "issue_currency"]
LOSS_KEYS = ["segment", "segment_name", "lowest_level_portfolio_name", "issue_currency",
             "segment_issuecurrency"]
PORTFOLIO = "lowest_level_portfolio_name"


@dataclass(frozen=True)
class UnhedgedInputs:
    """Sensitivities, shifts and shocks of one quarter with their dimensions."""

    sensitivities: DataFrame
    tenors: DataFrame
    shocks: DataFrame
    hierarchy: DataFrame
    shifts: DataFrame
    exclusions: DataFrame
    average: DataFrame


@dataclass(frozen=True)
class UnhedgedRules:
    """Codes and units: ordered segment rules, currency recodes, shift names, divisors.

    Without ``tenors`` the job takes them from the tenor dimension. ``repeated_shocks`` is the
    aggregate for shocks that occur twice for a point.
    """

    tenors: list[int] | None
    segment_rules: list[tuple[str | Column, str]]
    default_segment: str
    shift_up: str
    shift_down: str
    currency_codes: Mapping[str, str] = field(default_factory=dict)
    loss_unit: float = 10.0
    gamma_unit: float = 1_000_000.0
    gamma_factor: float = 4.0
    p: float = 0.95
    repeated_shocks: str = "sum"


def dimension_tenors(tenors: DataFrame) -> list[int]:
    """The tenors in months that a dimension holds; each becomes a column."""
    months = tenors.where("tenor_months is not null").select("tenor_months").distinct()
    return sorted(r["tenor_months"] for r in months.collect())


def read_inputs(sensitivities: DataFrame, tenors: DataFrame, shocks: DataFrame,
                hierarchy: DataFrame, shifts: DataFrame, exclusions: DataFrame,
                average: DataFrame, quarter: date, markets: list[str], category: str,
                rules: UnhedgedRules) -> UnhedgedInputs:
    """Newest loads of one quarter, reduced to these markets outside hedge programmes."""
    day = F.lit(quarter)
    unhedged = ((F.col("report_date") == day) & F.col("market").isin(markets)
                & F.col("hedge_program").isNull())
    parallel = (F.col("shift_name").isin(rules.shift_up, rules.shift_down)
                & (F.col("scenario_category") == category))
    return UnhedgedInputs(
        sensitivities=latest_snapshot(sensitivities, unhedged),
        tenors=latest_snapshot(tenors, "is_active"),
        shocks=latest_snapshot(shocks, F.col("effective_date") == day),
        hierarchy=latest_snapshot(hierarchy),
        shifts=latest_snapshot(shifts, unhedged & parallel),
        exclusions=latest_snapshot(exclusions),
        average=latest_snapshot(average, F.col("reporting_date") == day))


def first_order_points(sensitivities: DataFrame, tenors: DataFrame,
                       scale: int | None = None) -> DataFrame:
    """Sensitivities summed per group and tenor; the tenor follows from the factor code."""
    dimension = tenors.select(F.upper("tenor_code").alias("_code"), "tenor_months")
    rows = sensitivities.select(*GROUP, "risk_factor_name", "delta")
    return (rows.join(dimension, F.upper("risk_factor_name") == F.col("_code"))
            .groupBy(*GROUP, "tenor_months")
            .agg(total("delta", scale).alias("sum_post_tax")))


def first_order_rows(points: DataFrame, rules: UnhedgedRules) -> Staged:
    """Curve rows per group after the currency recode, staged."""
    coded = points.withColumn("issue_currency",
                              recode("issue_currency", dict(rules.currency_codes)))
    rows = curve_rows(coded, GROUP, "tenor_months", "sum_post_tax", rules.tenors, "e")
    return stage(rows.withColumn("currency", F.upper("issue_currency")), "first-order")


def scenario_rows(shocks: DataFrame, tenors: DataFrame, rules: UnhedgedRules) -> DataFrame:
    """One curve row per currency and scenario, for the tenors of the dimension."""
    dimension = tenors.select(tenor_months("tenor_years").alias("_at"), "tenor_months")
    rows = (shocks.join(dimension, tenor_months("tenor") == F.col("_at"))
            .select(F.upper("currency").alias("currency"), "tenor_months", "scenario",
                    "shocks"))
    return shock_rows(rows, ["currency"], "scenario", "tenor_months", "shocks", rules.tenors,
                      repeated=rules.repeated_shocks)


def repeated_shocks(shocks: DataFrame) -> DataFrame:
    """Points of the scenario table that occur more than once, with their number of rows."""
    points = shocks.select(F.upper("currency").alias("currency"), "scenario",
                           tenor_months("tenor").alias("tenor_months"))
    return duplicate_keys(points, points.columns)


def first_order_losses(exposure: Staged, shocks: DataFrame, hierarchy: DataFrame,
                       rules: UnhedgedRules, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Amount per portfolio and scenario with the quantile of its group."""
    losses = scenario_losses(exposure, shocks, keys=GROUP, curve=["currency"],
                             scenario="scenario", tenors=rules.tenors,
                             divisor=rules.loss_unit, loss="amount", limit=limit)
    rated = with_quantile(losses.drop("tenor_count"), GROUP, "amount", "quantile", rules.p,
                          small=exposure.fits(limit))
    return _with_portfolio(rated, hierarchy, []).select(
        F.col("market").alias("segment"), "segment_name", PORTFOLIO, "issue_currency",
        concat_key("market", "issue_currency").alias("segment_issuecurrency"), "scenario",
        "amount", "quantile")


def _with_portfolio(df: DataFrame, hierarchy: DataFrame, extra: list[str]) -> DataFrame:
    """Inner join on the normalised segment name; a repeated name repeats the rows."""
    side = hierarchy.select(normalize_text("segment_name").alias("_segment"), PORTFOLIO,
                            *extra)
    return df.join(side, normalize_text("segment_name") == F.col("_segment")).drop("_segment")


def gammas(shifts: DataFrame, hierarchy: DataFrame, exclusions: DataFrame,
           rules: UnhedgedRules, scale: int | None = None) -> DataFrame:
    """Gamma per loss key from the two parallel shifts of the segments not excluded.

    Sensitivities are summed before the lookups; tax is constant within such a sum.
    """
    kept = exclusions.where(F.col("exclude") == "No").select(
        normalize_text("segment_name").alias("_kept"))
    summed = shifts.groupBy("market", "segment_name", "country", "issue_currency",
                            "shift_name").agg(total("sensitivity", scale)
                                              .alias("sensitivity"))
    rows = _with_portfolio(summed, hierarchy, ["tax_rate"])
    rows = rows.join(kept, normalize_text("segment_name") == F.col("_kept")).drop("_kept")
    rows = rows.withColumn("issue_currency",
                           recode("issue_currency", dict(rules.currency_codes)))
    rows = rows.withColumns({
        "segment_issuecurrency": concat_key("market", "issue_currency"),
        "segment": classify_rules(rules.segment_rules, rules.default_segment),
        "post_tax": post_tax("sensitivity", "tax_rate", rules.gamma_unit)})
    return parallel_gamma(rows, LOSS_KEYS, "shift_name", "post_tax", rules.shift_up,
                          rules.shift_down, rules.gamma_factor)


def gamma_rows(gamma: DataFrame) -> Staged:
    return stage(gamma.withColumn("currency", F.upper("issue_currency")), "gamma")


def second_order_losses(gamma: Staged, average: DataFrame, rules: UnhedgedRules,
                        limit: int = BROADCAST_ROWS) -> DataFrame:
    """Second-order amount per loss key and scenario, with the quantile of the key.

    ``average`` holds currency, scenario and average_shock.
    """
    shocks = average.select(F.upper("currency").alias("currency"), "scenario",
                            "average_shock")
    return scenarios.second_order_losses(
        gamma, shocks, curve=["currency"], scenario="scenario", keys=LOSS_KEYS, p=rules.p,
        limit=limit).drop("currency")


def total_losses(first: DataFrame, second: DataFrame) -> DataFrame:
    """Total of two stored loss tables, for keys and scenarios found in both."""
    return scenarios.total_losses(first, second, LOSS_KEYS, "scenario",
                                  normalized={PORTFOLIO: normalize_text(PORTFOLIO)})


STORED_KEYS = [*[k for k in LOSS_KEYS if k != PORTFOLIO], "portfolio_key", "scenario"]


def store_losses(losses: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write a loss table laid out for the total: bucketed and sorted by the keys of its join.

    The portfolio is compared without regard to case and blanks, so its normalised name is a
    column of the table and one of the keys.
    """
    write_bucketed(losses.withColumn("portfolio_key", normalize_text(PORTFOLIO)), table,
                   STORED_KEYS, buckets, path)


def total_of_stored(first: DataFrame, second: DataFrame) -> DataFrame:
    """Total of two tables of ``store_losses``; with equal buckets nothing is exchanged."""
    right = second.select(*STORED_KEYS, F.col("amount").alias("_second"))
    return first.join(right, STORED_KEYS).select(
        *LOSS_KEYS, "scenario", (F.col("amount") + F.col("_second")).alias("amount"))


def with_average(shocks: DataFrame, average: DataFrame) -> DataFrame:
    """Scenario rows with their average shock: one row per scenario on both sides."""
    averages = average.select(F.upper("currency").alias("currency"), "scenario",
                              "average_shock")
    return shocks.join(averages, ["currency", "scenario"])


def combined_losses(exposure: Staged, gamma: Staged, hierarchy: DataFrame,
                    shocks: DataFrame, rules: UnhedgedRules,
                    limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same total in one pass: group rows meet first, then every scenario once.

    ``shocks`` are scenario rows that carry ``average_shock``. Neither loss table is
    built or shuffled; the staged group rows are matched to the scenarios directly.
    """
    keyed = _with_portfolio(exposure.df, hierarchy, []).withColumns({
        "segment": F.col("market"),
        "segment_issuecurrency": concat_key("market", "issue_currency")})
    compared = {k: normalize_text(k) if k == PORTFOLIO else F.col(k) for k in LOSS_KEYS}
    right = gamma.df.select(*[e.alias(f"_{k}") for k, e in compared.items()], "gamma")
    same = [e == F.col(f"_{k}") for k, e in compared.items()]
    groups = stage(keyed.join(right, same).drop(*[f"_{k}" for k in LOSS_KEYS]), "groups")
    pairs = pair_scenarios(groups, shocks, ["currency"], "scenario", limit=limit)
    first = sum_product(rules.tenors, "e", "s") / rules.loss_unit
    return pairs.select(*LOSS_KEYS, "scenario",
                        (first + second_order("gamma", "average_shock")).alias("amount"))
