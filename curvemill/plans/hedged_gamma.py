"""Inputs of the hedged-book gamma: five snapshots of one quarter.

Only the inputs are defined; there is no formula to compute from them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.calendar import next_month_start
from curvemill.operators.quality import require_rows
from curvemill.sources.snapshots import latest_snapshot


@dataclass(frozen=True)
class HedgedGammaInputs:
    derivatives: DataFrame
    sensitivities: DataFrame
    proportions: DataFrame
    cash_flows: DataFrame
    forward_curve: DataFrame


def read_inputs(asset_summary: DataFrame, sensitivities: DataFrame, proportions: DataFrame,
                cash_flows: DataFrame, forward_curve: DataFrame, quarter: date,
                program: str) -> HedgedGammaInputs:
    """Newest loads; month-start extracts carry the first day after the quarter."""
    end = F.lit(quarter)
    start = next_month_start(end)
    inputs = HedgedGammaInputs(
        derivatives=latest_snapshot(
            asset_summary, (F.col("report_date") == end) & F.col("hedge_program").isNotNull()
            & (F.col("is_derivatives") == 1)),
        sensitivities=latest_snapshot(
            sensitivities,
            (F.col("report_date") == start) & (F.col("hedge_program") == program)),
        proportions=latest_snapshot(proportions, F.col("effective_date") == start),
        cash_flows=latest_snapshot(cash_flows, F.col("as_of_date") == end),
        forward_curve=latest_snapshot(forward_curve, F.col("reporting_date") == end))
    require_rows(vars(inputs))
    return inputs
