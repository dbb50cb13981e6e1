"""The two analytics as jobs: check the inputs, compute, write every result once.

A result that feeds the next step is staged, so only staged tables are reused. Checks come
back as report tables, or as counts taken while a result is written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions.keys import normalize_text
from curvemill.operators import quality
from curvemill.operators.curves import missing_tenors
from curvemill.operators.lookups import unparsed_dates
from curvemill.plans import hedged, unhedged
from curvemill.plans.hedged import HedgedInputs, HedgedRules
from curvemill.plans.unhedged import UnhedgedInputs, UnhedgedRules
from curvemill.sources.loads import write_load
from curvemill.sources.sinks import add_audit_columns, write_table
from curvemill.staging import stage

Writer = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class JobReport:
    """Report tables per check, and counts taken during the writes."""

    tables: Mapping[str, DataFrame]
    counts: Mapping[str, int]


def table_writer(targets: Mapping[str, str], kind: str, now: Column, zone: str,
                 reporting_date: date | None = None, valuation_date: date | None = None,
                 partition_by: Mapping[str, str] | None = None, load: str | None = None) -> Writer:
    """A writer that stamps each result with its audit columns and appends it.

    With the name of a ``load`` the targets are folders of loads, and a job that is repeated under
    the same name replaces what it wrote before.
    """

    def write(df: DataFrame, name: str) -> None:
        stamped = add_audit_columns(df, kind, now, zone, reporting_date=reporting_date,
                                    valuation_date=valuation_date)
        if load:
            write_load(stamped, targets[name], load)
        else:
            write_table(stamped, targets[name], partition_by=(partition_by or {}).get(name))

    return write


def run_hedged(inputs: HedgedInputs, rules: HedgedRules, write: Writer) -> JobReport:
    """Writes ``sensitivities``, ``net_exposure`` and ``losses``."""
    quality.require_rows({f"feed {i}": f for i, f in enumerate(inputs.feeds, 1)} | {
        "rates": inputs.rates, "hierarchy": inputs.hierarchy,
        "portfolio map": inputs.portfolio_map, "shocks": inputs.shocks})
    quality.require_unique(inputs.portfolio_map, hedged.MAP_KEYS, "The portfolio map")
    write(hedged.long_sensitivities(inputs.feeds), "sensitivities")

    rows, tenors = hedged.net_exposure_rows(inputs, rules)
    rows = stage(rows, "net-exposure").df
    net = hedged.net_exposure(rows, tenors)
    counted, no_net = quality.counting(net, no_net=F.col("sum_partial_dv01").isNull())
    write(counted, "net_exposure")

    exposure = hedged.loss_exposure(rows, tenors, rules)
    losses = hedged.class_losses(exposure, inputs.shocks, tenors, rules)
    counts = [f"{c}_tenors" for c in rules.loss_columns.values()]
    partial = reduce(lambda a, b: a | b, [
        ~F.col(c).isin(0, len(tenors)) for c in counts])
    counted, incomplete = quality.counting(losses, partial_curves=partial)
    write(counted.drop(*counts), "losses")

    shocks = hedged.scenario_rows(inputs.shocks, tenors)
    tables = hedged.lookup_reports(rows) | {
        "shocks": missing_tenors(exposure.df, shocks, ["security_currency"], tenors),
        "unparsed rate dates": unparsed_dates(inputs.rates, "date", rules.rate_date_format)}
    return JobReport(tables, {**no_net.get, **incomplete.get})


def run_unhedged(inputs: UnhedgedInputs, rules: UnhedgedRules, write: Writer) -> JobReport:
    """Writes ``post_tax``, ``first_order``, ``gamma``, ``second_order`` and ``total``."""
    quality.require_rows({f.name: getattr(inputs, f.name) for f in fields(inputs)})
    codes = inputs.tenors.select(F.upper("tenor_code").alias("tenor_code"))
    quality.require_unique(codes, ["tenor_code"], "The tenor dimension")
    if rules.tenors is None:
        rules = replace(rules, tenors=unhedged.dimension_tenors(inputs.tenors))
    points = stage(unhedged.first_order_points(inputs.sensitivities, inputs.tenors),
                   "post-tax").df
    write(points.withColumn("hedge_program", F.lit(None).cast("string")), "post_tax")

    exposure = unhedged.first_order_rows(points, rules)
    shocks = unhedged.scenario_rows(inputs.shocks, inputs.tenors, rules)
    first = unhedged.first_order_losses(exposure, shocks, inputs.hierarchy, rules)
    write(first.withColumn("hedge_program", F.lit(None).cast("string")), "first_order")

    gamma = unhedged.gamma_rows(unhedged.gammas(
        inputs.shifts, inputs.hierarchy, inputs.exclusions, rules))
    write(gamma.df.drop("currency"), "gamma")
    write(unhedged.second_order_losses(gamma, inputs.average, rules), "second_order")

    scenarios = unhedged.with_average(shocks, inputs.average)
    write(unhedged.combined_losses(exposure, gamma, inputs.hierarchy, scenarios, rules),
          "total")
    repeated = quality.duplicate_keys(inputs.hierarchy.select(
        normalize_text("segment_name").alias("segment_name")), ["segment_name"])
    return JobReport({"repeated segments": repeated,
                      "repeated shocks": unhedged.repeated_shocks(inputs.shocks)}, {})
