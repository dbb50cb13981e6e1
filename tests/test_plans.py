from datetime import date

import pytest
from pyspark.sql import functions as F

from curvemill.plans import hedged, hedged_gamma, unhedged
from curvemill.staging import stage
from tests.conftest import as_tuples

QUARTER = date(2026, 3, 31)
CLASSES = {"Bond": ["P1", "P3"], "Liability": ["P2"]}
LOSSES = {"Liability": "loss_liability", "Bond": "loss_bond"}


def hedged_inputs(rows, inception="2026-04-01", rate_day=QUARTER):
    feed = ("asset_type string, inception_date string, program_code string, legal_id string, "
            "security_currency string, source string, `003M` double, `006M` string")
    rates = rows([("usd ", 0.5, rate_day, 1)],
                 "code string, bs_rate double, date date, ingestion_ts int")
    return hedged.HedgedInputs(
        feeds=[
            rows([("a", inception, " p1", "7", "usd", "f", 600.0, None),
                  ("a", inception, "P2", "7", "bas ", "f", 1000.0, "10")], feed),
            rows([("a", inception, "p1 ", "7", "USD", "d", 400.0, "8"),
                  ("a", inception, "P9", "7", "JPY", "d", 1000.0, "10")], feed)],
        rates=rates,
        hierarchy=rows([("BOOK  one", 2, 0.2), ("Book One", 1, 0.9), ("book two", 1, 0.25),
                        ("book three", 1, 0.0)],
                       "lowest_level_portfolio_name string, reporting_date_key int, "
                       "tax_rate double"),
        portfolio_map=rows([("P1", 7, "USD", "Book One"), ("P2", 7, "BAS", "Book Two"),
                            ("P9", 7, "JPY", "Book Three")],
                           "program_code string, legal_id int, security_currency string, "
                           "lowest_level_portfolio_name string"),
        shocks=rows([("usd", 0.25, 1, 2.0), ("USD ", 0.5, 1, 3.0), ("bas", 0.25, 1, 5.0),
                     ("jpy", 0.25, 1, 7.0), ("bas", 30.0, 1, 5.0)],
                    "currency string, tenor double, scenario int, shocks double")
        .withColumns({"effective_date": F.lit(QUARTER), "ingestion_ts": F.lit(1)}))


RULES = hedged.HedgedRules(base_currency="BAS", classes=CLASSES, loss_columns=LOSSES,
                           quarter=QUARTER)


def test_net_exposure(rows):
    net = hedged.net_exposure(*hedged.net_exposure_rows(hedged_inputs(rows), RULES))
    assert net.columns == hedged.NET_COLUMNS
    got = as_tuples(net.select("security_currency", "asset_holding", "tenor_cd", "total_dv01",
                               "fx_rate", "tax_rate", "sum_partial_dv01"))
    assert got == sorted([
        ("USD", "Bond", 0.25, 1000.0, 0.5, 0.2, 400.0), ("USD", "Bond", 0.5, 8.0, 0.5, 0.2, 3.2),
        ("BAS", "Liability", 0.25, 1000.0, 1.0, 0.25, 750.0),
        ("BAS", "Liability", 0.5, 10.0, 1.0, 0.25, 7.5),
        ("JPY", None, 0.25, 1000.0, None, 0.0, None),
        ("JPY", None, 0.5, 10.0, None, 0.0, None)], key=repr)
    assert {r["report_date"] for r in net.collect()} == {QUARTER}


def test_lookup_reports(rows):
    found, _ = hedged.net_exposure_rows(hedged_inputs(rows), RULES)
    reports = {k: as_tuples(v) for k, v in hedged.lookup_reports(found).items()}
    assert reports == {"portfolio": [], "tax": [], "rate": [(QUARTER, "JPY")],
                       "class": [("P9",)]}


def class_losses(rows, rules, given):
    found, tenors = hedged.net_exposure_rows(given, rules)
    exposure = hedged.loss_exposure(found, tenors, rules)
    return hedged.class_losses(exposure, given.shocks, tenors, rules)


@pytest.mark.parametrize("keys", [RULES.loss_keys, [
    "report_date", "security_currency", hedged.PORTFOLIO]])
def test_class_losses(rows, keys):
    rules = hedged.HedgedRules(base_currency="BAS", classes=CLASSES, loss_columns=LOSSES,
                               quarter=QUARTER, loss_keys=keys)
    losses = class_losses(rows, rules, hedged_inputs(rows))
    got = as_tuples(losses.select("security_currency", "scenario", "loss_liability", "loss_bond",
                                  "loss_liability_tenors", "loss_bond_tenors"))
    assert got == sorted([
        ("USD", 1, None, (400.0 * 2 + 3.2 * 3) * 100, 0, 2),
        ("BAS", 1, 750.0 * 5 * 100, None, 1, 0),
        ("JPY", 1, None, None, 0, 0)], key=repr)


def test_report_date_from_inception_and_rates_by_date(rows):
    rules = hedged.HedgedRules(base_currency="BAS", classes=CLASSES, loss_columns=LOSSES)
    given = hedged_inputs(rows, "2026-05-01", date(2026, 4, 30))
    found, tenors = hedged.net_exposure_rows(given, rules)
    net = hedged.net_exposure(found, tenors).where("security_currency = 'USD'")
    assert {(r["report_date"], r["fx_rate"]) for r in net.collect()} == {
        (date(2026, 4, 30), 0.5)}
    late = hedged_inputs(rows, "2026-06-01", date(2026, 4, 30))
    found, tenors = hedged.net_exposure_rows(late, rules)
    assert found.where("security_currency = 'USD'").first()["fx_rate"] is None


def test_shocks_for_the_report_date(rows):
    net = rows([(date(2026, 4, 30),)], "report_date date")
    shocks = rows([(date(2026, 3, 31), 1), (date(2026, 3, 31), 2), (date(2026, 6, 30), 1)],
                  "effective_date date, ingestion_ts int")
    assert as_tuples(hedged.shocks_for(net, shocks)) == [(date(2026, 6, 30), 1)]
    old = shocks.where("effective_date < '2026-04-01'")
    assert as_tuples(hedged.shocks_for(net, old)) == [(date(2026, 3, 31), 2)]


def test_inputs_of_a_quarter(rows):
    given = hedged_inputs(rows)
    feeds = [f.withColumns({"inception_date": F.to_date("inception_date"),
                            "ingestion_ts": F.lit(1)}) for f in given.feeds]
    got = hedged.read_inputs(feeds, given.rates, given.hierarchy.withColumn(
        "ingestion_ts", F.lit(1)), given.portfolio_map, given.shocks, QUARTER)
    assert [f.count() for f in got.feeds] == [2, 2]
    other = hedged.read_inputs(feeds, given.rates, given.hierarchy.withColumn(
        "ingestion_ts", F.lit(1)), given.portfolio_map, given.shocks, date(2026, 6, 30))
    assert [f.count() for f in other.feeds] == [0, 0] and other.shocks.count() == 0


def test_long_sensitivities(rows):
    long = hedged.long_sensitivities(hedged_inputs(rows).feeds)
    assert long.count() == 8
    got = as_tuples(long.where("program_code = 'P1' and tenor_cd = 0.5")
                    .select("source", "legal_id", "dv01_value"))
    assert got == [("d", 7, 8.0), ("f", 7, 0.0)]


UNHEDGED = unhedged.UnhedgedRules(
    tenors=[3, 6], segment_rules=[("upper(country) = 'US'", "WEST")], default_segment="EAST",
    shift_up="UP", shift_down="DOWN", currency_codes={"CNH": "CNY"}, gamma_unit=1.0)


def unhedged_parts(rows):
    sensitivities = rows(
        [("WEST", "Seg A", "usd", "ir3m", 10.0), ("WEST", "Seg A", "usd", "IR6M", 20.0),
         ("WEST", "Seg A", "usd", "spread", 99.0), ("EAST", "Seg B", "CNH", "IR3M", 1.0),
         ("EAST", "Seg B", "CNY", "IR3M", 2.0)],
        "market string, segment_name string, issue_currency string, risk_factor_name string, "
        "delta double")
    tenors = rows([("IR3M", 3, 0.25), ("IR6M", 6, 0.5)],
                  "tenor_code string, tenor_months int, tenor_years double")
    hierarchy = rows([(" seg  a", "Book A", 0.5), ("SEG B", "Book B", 0.0)],
                     "segment_name string, lowest_level_portfolio_name string, tax_rate double")
    shocks = rows([("USD", 0.25, 1, 1.0), ("USD", 0.5, 1, 2.0), ("USD", 0.25, 2, 3.0),
                   ("cny", 0.25, 1, 10.0), ("cny", 2.0, 1, 10.0)],
                  "currency string, tenor double, scenario int, shocks double")
    return sensitivities, tenors, hierarchy, shocks


def first_order(rows):
    sensitivities, tenors, hierarchy, shocks = unhedged_parts(rows)
    exposure = unhedged.first_order_rows(
        unhedged.first_order_points(sensitivities, tenors), UNHEDGED)
    table = unhedged.scenario_rows(shocks, tenors, UNHEDGED)
    return exposure, table, hierarchy


def test_first_order_losses(rows):
    exposure, table, hierarchy = first_order(rows)
    found = unhedged.first_order_losses(exposure, table, hierarchy, UNHEDGED)
    assert as_tuples(found) == [
        ("EAST", "Seg B", "Book B", "CNY", "EASTCNY", 1, 3.0, 3.0),
        ("WEST", "Seg A", "Book A", "usd", "WESTusd", 1, 5.0, 5.0),
        ("WEST", "Seg A", "Book A", "usd", "WESTusd", 2, 3.0, 5.0)]


def gamma(rows, hierarchy):
    shifts = rows(
        [("WEST", "Seg A", "US", "usd", "UP", 3.0), ("WEST", "Seg A", "us", "usd", "UP", 3.0),
         ("WEST", "Seg A", "US", "usd", "DOWN", -2.0),
         ("EAST", "Seg B", "CN", "CNH", "UP", 1.0), ("EAST", "Seg B", "CN", "CNH", "DOWN", 1.0)],
        "market string, segment_name string, country string, issue_currency string, "
        "shift_name string, sensitivity double")
    exclusions = rows([("SEG A", "No"), ("seg b ", "Yes")],
                      "segment_name string, exclude string")
    return unhedged.gammas(shifts, hierarchy, exclusions, UNHEDGED)


def test_gamma_and_totals_on_every_path(rows):
    exposure, table, hierarchy = first_order(rows)
    gammas = gamma(rows, hierarchy)
    assert as_tuples(gammas) == [("WEST", "Seg A", "Book A", "usd", "WESTusd", 3.0, -1.0, 8.0)]
    average = rows([("usd", 1, 0.5), ("USD", 2, 1.0), ("usd", 3, 2.0)],
                   "currency string, scenario int, average_shock double")
    staged = unhedged.gamma_rows(gammas)
    for limit in (100, 0):
        second = unhedged.second_order_losses(staged, average, UNHEDGED, limit)
        assert as_tuples(second.select("scenario", "amount", "quantile")) == [
            (1, 1.0, 16.0), (2, 4.0, 16.0), (3, 16.0, 16.0)]
        first = unhedged.first_order_losses(exposure, table, hierarchy, UNHEDGED, limit)
        joined = unhedged.total_losses(stage(first, "first").df, stage(second, "second").df)
        combined = unhedged.combined_losses(
            exposure, staged, hierarchy, unhedged.with_average(table, average), UNHEDGED, limit)
        expected = [("WEST", "Seg A", "Book A", "usd", "WESTusd", 1, 6.0),
                    ("WEST", "Seg A", "Book A", "usd", "WESTusd", 2, 7.0)]
        assert as_tuples(joined) == as_tuples(combined) == expected


def test_hedged_gamma_inputs(rows):
    after = date(2026, 4, 1)
    summary = rows([(QUARTER, "H1", 1, 1), (QUARTER, "H1", 1, 2), (QUARTER, None, 1, 3),
                    (QUARTER, "H1", 0, 3), (after, "H1", 1, 3)],
                   "report_date date, hedge_program string, is_derivatives int, "
                   "ingestion_ts int")
    observed = rows([(after, "H1", 1), (after, "H2", 2), (QUARTER, "H1", 3)],
                    "report_date date, hedge_program string, ingestion_ts int")

    def dated(column, day):
        return rows([(day, 1), (date(2025, 12, 31), 2)], f"{column} date, ingestion_ts int")

    parts = [summary, observed, dated("effective_date", after), dated("as_of_date", QUARTER),
             dated("reporting_date", QUARTER)]
    got = hedged_gamma.read_inputs(*parts, QUARTER, "H1")
    assert as_tuples(got.derivatives) == [(QUARTER, "H1", 1, 2)]
    assert as_tuples(got.sensitivities) == [(after, "H1", 1)]
    assert [d.count() for d in (got.proportions, got.cash_flows, got.forward_curve)] == [1] * 3
    with pytest.raises(ValueError, match="empty: sensitivities"):
        hedged_gamma.read_inputs(*parts, QUARTER, "H3")
