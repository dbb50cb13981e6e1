"""Losses of the hedged book: wide sensitivities -> net exposure -> losses per scenario.

The feeds arrive as one column per tenor and stay that way: they are summed per key as
curve rows, enriched at that grain and multiplied with one row per scenario. The long
form is produced only where it is asked for as a result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import base_rate, net_amount, zero_if_null
from curvemill.functions.calendar import next_month_start, report_date
from curvemill.functions.keys import classify, clean_code, normalize_text
from curvemill.operators.curves import (
    curve_points, tenor_months, unpivot_curve, wide_curve_rows, zero_tenors)
from curvemill.operators.lookups import (
    lookup, rates_by_currency, rates_by_date, tax_by_portfolio)
from curvemill.operators.quality import missing_lookups
from curvemill.operators.scenarios import class_curve_rows, losses_by_class, shock_rows
from curvemill.operators.shaping import union_feeds
from curvemill.sources.snapshots import latest_snapshot, shock_set_for_date
from curvemill.staging import BROADCAST_ROWS, Staged, stage

# Column names of the feeds, the portfolio map and the result.
FEED_KEYS = ["asset_type", "inception_date", "program_code", "legal_id",
             "security_currency", "source"]
TOTAL_KEYS = ["report_date", "program_code", "legal_id", "security_currency"]
MAP_KEYS = ["program_code", "legal_id", "security_currency"]
PORTFOLIO = "lowest_level_portfolio_name"
NET_COLUMNS = ["report_date", "security_currency", "asset_holding", "tenor_cd",
               "program_code", PORTFOLIO, "legal_id", "total_dv01", "fx_rate", "tax_rate",
               "sum_partial_dv01"]


@dataclass(frozen=True)
class HedgedInputs:
    """Wide feeds, currency rates, portfolio hierarchy, portfolio map and shocks."""

    feeds: list[DataFrame]
    rates: DataFrame
    hierarchy: DataFrame
    portfolio_map: DataFrame
    shocks: DataFrame


@dataclass(frozen=True)
class HedgedRules:
    """What differs between books: codes, units and the choice of dates.

    ``quarter`` fixes the report date. Without it the date follows from each row's
    inception date, and rates are matched by currency and date. ``scale`` is the number of
    decimals up to which sums of sensitivities are exact.
    """

    base_currency: str
    classes: Mapping[str, list[str]]
    loss_columns: Mapping[str, str]
    quarter: date | None = None
    multiplier: float = 100.0
    loss_keys: list[str] = field(default_factory=lambda: [
        "report_date", "security_currency", "asset_holding", PORTFOLIO, "legal_id"])
    rate_date_format: str = "dd-MMM-yy"
    scale: int | None = None


def read_inputs(feeds: list[DataFrame], rates: DataFrame, hierarchy: DataFrame,
                portfolio_map: DataFrame, shocks: DataFrame, quarter: date) -> HedgedInputs:
    """Newest loads of one quarter; feeds are stamped on the first day after it."""
    day = F.lit(quarter)
    return HedgedInputs(
        feeds=[latest_snapshot(f, F.col("inception_date") == next_month_start(day))
               for f in feeds],
        rates=latest_snapshot(rates, F.col("date") == day),
        hierarchy=latest_snapshot(hierarchy),
        portfolio_map=portfolio_map,
        shocks=latest_snapshot(shocks, F.col("effective_date") == day))


def shocks_for(net: DataFrame, shocks: DataFrame, not_after: bool = False) -> DataFrame:
    """Newest load of the shock set that is valid for the newest report date."""
    newest = net.agg(F.max("report_date").alias("report_date"))
    chosen = shock_set_for_date(newest, shocks, "report_date", "effective_date", not_after)
    return latest_snapshot(
        shocks, F.col("effective_date") == chosen.select("effective_date").scalar())


def _cleaned(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "inception_date": F.try_to_date("inception_date"),
        "program_code": clean_code("program_code"),
        "security_currency": clean_code("security_currency"),
        "legal_id": F.col("legal_id").try_cast("int")})


def long_sensitivities(feeds: list[DataFrame]) -> DataFrame:
    """All feeds as rows of (keys, tenor in years, value), cleaned, nulls as zero."""
    rows = union_feeds([unpivot_curve(f, FEED_KEYS, "tenor_cd", "dv01_value") for f in feeds])
    return _cleaned(rows).withColumn("dv01_value", zero_if_null("dv01_value"))


def net_exposure_rows(inputs: HedgedInputs, rules: HedgedRules
                      ) -> tuple[DataFrame, list[int]]:
    """Net exposure as curve rows (total: prefix e, net: prefix n) and the tenors."""
    wide = _cleaned(union_feeds([zero_tenors(f) for f in inputs.feeds], fill_missing=True))
    dated = wide.withColumn(
        "report_date",
        report_date("inception_date") if rules.quarter is None
        else F.lit(rules.quarter).cast("date"))
    rows, tenors = wide_curve_rows(dated, TOTAL_KEYS, "e", rules.scale)
    rows = lookup(rows, inputs.portfolio_map, {k: k for k in MAP_KEYS}, [PORTFOLIO])
    tax = tax_by_portfolio(inputs.hierarchy, PORTFOLIO, "reporting_date_key", "tax_rate")
    rows = lookup(rows, tax, {"portfolio_key": normalize_text(PORTFOLIO)}, ["tax_rate"])
    if rules.quarter is None:
        rates = rates_by_date(inputs.rates, "code", "bs_rate", "date",
                              rules.rate_date_format, "ingestion_ts")
        on = {"fx_currency": "security_currency", "fx_date": "report_date"}
    else:
        rates = rates_by_currency(inputs.rates, "code", "bs_rate")
        on = {"fx_currency": "security_currency"}
    rows = lookup(rows, rates, on, ["fx_rate"])
    rows = rows.withColumn("fx_rate", base_rate("fx_rate", "security_currency",
                                                rules.base_currency))
    rows = rows.withColumn("asset_holding", classify("program_code", dict(rules.classes)))
    return rows.withColumns({
        f"n{m}": net_amount(f"e{m}", "fx_rate", "tax_rate") for m in tenors}), tenors


def net_exposure(rows: DataFrame, tenors: list[int]) -> DataFrame:
    """The long result: one row per curve point with its total, rates and net value."""
    keys = [c for c in NET_COLUMNS if c not in ("tenor_cd", "total_dv01", "sum_partial_dv01")]
    return curve_points(rows, keys, tenors, "emask", "tenor_cd",
                        {"e": "total_dv01", "n": "sum_partial_dv01"}).select(*NET_COLUMNS)


def lookup_reports(rows: DataFrame) -> dict[str, DataFrame]:
    """Keys that a lookup left without a value, per lookup."""
    return {
        "portfolio": missing_lookups(rows, PORTFOLIO, MAP_KEYS),
        "tax": missing_lookups(rows, "tax_rate", [PORTFOLIO]),
        "rate": missing_lookups(rows, "fx_rate", ["report_date", "security_currency"]),
        "class": missing_lookups(rows, "asset_holding", ["program_code"]),
    }


def loss_exposure(rows: DataFrame, tenors: list[int], rules: HedgedRules) -> Staged:
    """Net exposure at the grain of the losses, one block of tenors per class, staged."""
    return stage(class_curve_rows(rows, rules.loss_keys, "asset_holding",
                                  list(rules.loss_columns), tenors, "n", "emask"),
                 "loss-exposure")


def scenario_rows(shocks: DataFrame, tenors: list[int]) -> DataFrame:
    cleaned = shocks.select(
        clean_code("currency").alias("security_currency"),
        tenor_months(F.col("tenor").try_cast("double")).alias("months"),
        F.col("scenario").try_cast("int").alias("scenario"),
        F.col("shocks").try_cast("double").alias("shock"))
    return shock_rows(cleaned.where("scenario is not null"), ["security_currency"],
                      "scenario", "months", "shock", tenors)


def class_losses(exposure: Staged, shocks: DataFrame, tenors: list[int],
                 rules: HedgedRules, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Losses and tenor counts per loss key and scenario, one column pair per class."""
    return losses_by_class(exposure, scenario_rows(shocks, tenors), keys=rules.loss_keys,
                           curve=["security_currency"], scenario="scenario",
                           tenors=tenors, columns=rules.loss_columns,
                           multiplier=rules.multiplier, limit=limit)
