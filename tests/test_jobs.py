from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from curvemill.plans import jobs, unhedged
from curvemill.plans.hedged import NET_COLUMNS
from curvemill.sources import feeds, sinks
from tests import test_plans
from tests.conftest import as_tuples

QUARTER = test_plans.QUARTER


def writer(tmp_path, names):
    targets = {n: str(tmp_path / n) for n in names}
    now = F.lit("2026-05-11 12:00:00").cast("timestamp")
    return targets, jobs.table_writer(targets, sinks.REPORTING, now, "UTC", QUARTER)


def test_hedged_job(spark, rows, tmp_path):
    targets, write = writer(tmp_path, ["sensitivities", "net_exposure", "losses"])
    report = jobs.run_hedged(test_plans.hedged_inputs(rows), test_plans.RULES, write)
    audit = ["ingestion_ts", "reporting_date", "run_date"]
    net = spark.read.parquet(targets["net_exposure"])
    assert net.columns == NET_COLUMNS + audit and net.count() == 6
    losses = spark.read.parquet(targets["losses"])
    assert losses.columns == [*test_plans.RULES.loss_keys, "scenario", "loss_liability",
                              "loss_bond", *audit]
    assert losses.count() == 3
    assert spark.read.parquet(targets["sensitivities"]).count() == 8
    assert report.counts == {"no_net": 2, "partial_curves": 1}
    assert as_tuples(report.tables["shocks"]) == [("BAS", [6]), ("JPY", [6])]
    assert as_tuples(report.tables["class"]) == [("P9",)]


def test_hedged_job_refuses_empty_and_ambiguous_inputs(rows):
    given = test_plans.hedged_inputs(rows)

    def replaced(**parts):
        return type(given)(**{**given.__dict__, **parts})

    with pytest.raises(ValueError, match="empty: shocks"):
        jobs.run_hedged(replaced(shocks=given.shocks.where("false")), test_plans.RULES, None)
    twice = given.portfolio_map.union(given.portfolio_map)
    with pytest.raises(ValueError, match="The portfolio map has duplicate keys"):
        jobs.run_hedged(replaced(portfolio_map=twice), test_plans.RULES, None)


def test_unhedged_job(spark, rows, tmp_path):
    sensitivities, tenors, hierarchy, shocks = test_plans.unhedged_parts(rows)
    stamp = {"ingestion_ts": F.lit(1)}
    book = {"report_date": F.lit(QUARTER), "hedge_program": F.lit(None).cast("string"), **stamp}
    shifts = rows(
        [("WEST", "Seg A", "US", "usd", "UP", 6.0, "free"),
         ("WEST", "Seg A", "US", "usd", "DOWN", -2.0, "free"),
         ("WEST", "Seg A", "US", "usd", "DOWN", -50.0, "other"),
         ("NORTH", "Seg A", "US", "usd", "DOWN", -50.0, "free")],
        "market string, segment_name string, country string, issue_currency string, "
        "shift_name string, sensitivity double, scenario_category string")
    given = unhedged.read_inputs(
        sensitivities.withColumns(book),
        tenors.withColumns({"is_active": F.lit(True), **stamp}),
        shocks.withColumns({"effective_date": F.lit(QUARTER), **stamp}),
        hierarchy.withColumns(stamp), shifts.withColumns(book),
        rows([("SEG A", "No", 1)], "segment_name string, exclude string, ingestion_ts int"),
        rows([("usd", 1, 0.5, QUARTER, 1), ("usd", 2, 1.0, QUARTER, 1)],
             "currency string, scenario int, average_shock double, reporting_date date, "
             "ingestion_ts int"),
        QUARTER, ["WEST", "EAST"], "free", test_plans.UNHEDGED)
    targets, write = writer(tmp_path, ["post_tax", "first_order", "gamma", "second_order",
                                       "total"])
    report = jobs.run_unhedged(given, test_plans.UNHEDGED, write)
    tables = {n: spark.read.parquet(t) for n, t in targets.items()}
    assert {n: t.count() for n, t in tables.items()} == {
        "post_tax": 4, "first_order": 3, "gamma": 1, "second_order": 2, "total": 2}
    assert tables["gamma"].first()["gamma"] == 8.0
    assert tables["post_tax"].schema["hedge_program"].dataType.simpleString() == "string"
    assert as_tuples(tables["total"].select("scenario", "amount")) == [(1, 6.0), (2, 7.0)]
    assert report.tables["repeated segments"].count() == 0
    assert report.tables["repeated shocks"].count() == 0
    targets, write = writer(tmp_path / "again", list(targets))
    rules = replace(test_plans.UNHEDGED, tenors=None)
    jobs.run_unhedged(given, rules, write)
    assert as_tuples(spark.read.parquet(targets["total"]).select("scenario", "amount")) == [
        (1, 6.0), (2, 7.0)]


def test_append_newer_adds_nothing_twice(spark, rows, tmp_path):
    target = str(tmp_path / "raw")
    source = rows([(date(2026, 1, d), d) for d in range(1, 6)], "w date, v int")
    sinks.write_table(source.where("v <= 2"), target)
    for _ in range(2):
        feeds.append_newer(source, target, "w")
        assert as_tuples(spark.read.parquet(target).select("v")) == [(v,) for v in range(1, 6)]


def test_append_newer_by_a_timestamp_in_an_hour_that_repeats(spark, rows, tmp_path):
    target = str(tmp_path / "raw")
    moments = spark.range(4).select((F.lit(1793509200) + F.col("id") * 1800).alias("s"))
    source = moments.select(F.timestamp_seconds("s").alias("w"), "s")
    sinks.write_table(source.where("s < 1793512800"), target)
    for _ in range(2):
        feeds.append_newer(source, target, "w")
        assert spark.read.parquet(target).count() == 4


def test_refresh_dimension(spark, rows, tmp_path):
    target, source = str(tmp_path / "dim"), rows([(1,), (2,)], "v int")
    first = F.lit(datetime(2026, 1, 31, 12)).cast("timestamp")
    sinks.write_table(source.withColumn("ingestion_ts", first), target)
    now = F.lit(datetime(2026, 2, 1, 12)).cast("timestamp")
    for today, frequency, due, count in [
            (date(2026, 1, 31), "daily", False, 2), (date(2026, 2, 1), "annually", False, 2),
            (date(2026, 2, 1), "monthly", True, 4), (date(2026, 2, 1), "monthly", False, 4)]:
        assert feeds.refresh_dimension(source, target, frequency, F.lit(today), now) is due
        assert spark.read.parquet(target).count() == count
