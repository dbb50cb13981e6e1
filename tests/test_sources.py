from datetime import date

import pytest
from pyspark.sql import functions as F

from curvemill import staging
from curvemill.sources import feeds, sinks, snapshots
from tests.conftest import as_tuples


def test_filter_comes_before_the_newest_stamp(rows):
    df = rows([("A", 1), ("A", 2), ("A", 2), ("B", 3)], "k string, ingestion_ts int")
    assert as_tuples(snapshots.latest_snapshot(df, "k = 'A'")) == [("A", 2), ("A", 2)]
    assert as_tuples(snapshots.latest_snapshot(df)) == [("B", 3)]
    assert snapshots.latest_snapshot(df, "k = 'C'").count() == 0


def test_literal_rows(spark):
    df = snapshots.literal_rows(spark, [("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert as_tuples(df) == sorted([("a", 1), ("b", None)], key=repr)
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
    assert snapshots.literal_rows(spark, [], "k string").count() == 0


@pytest.mark.parametrize("on_file, not_after, expected", [
    ([date(2026, 3, 31), date(2026, 6, 30)], False, date(2026, 6, 30)),
    ([date(2026, 3, 31)], False, date(2026, 3, 31)),
    ([date(2026, 3, 31), date(2026, 9, 30)], False, date(2026, 9, 30)),
    ([date(2026, 3, 31), date(2026, 9, 30)], True, date(2026, 3, 31)),
    ([date(2026, 9, 30)], True, None),
    ([], False, None)])
def test_shock_set(rows, on_file, not_after, expected):
    days = rows([(date(2026, 4, 30),)], "day date")
    sets = rows([(d,) for d in on_file], "effective date")
    found = snapshots.shock_set_for_date(days, sets, "day", "effective", not_after)
    assert as_tuples(found) == [(date(2026, 4, 30), expected)]


def context(rows, today, forecasts):
    dates = rows([(20260511, date(2026, 5, 11), date(2026, 3, 31), 2),
                  (20260511, date(2026, 5, 11), date(2025, 12, 31), 1)],
                 "date_key int, day date, previous_quarter_end date, ingestion_ts int")
    forecast = rows(forecasts, "forecast_day date, forecast_seq int, ingestion_ts int")
    return snapshots.date_context(dates, forecast, F.lit(today), day="day",
                                  forecast_day="forecast_day", order=["date_key"])


def test_date_context(rows):
    forecasts = [(date(2026, 5, 8), 1, 7), (date(2026, 5, 12), 2, 7), (date(2026, 5, 10), 3, 6)]
    row = snapshots.require_context(context(rows, date(2026, 5, 11), forecasts),
                                    "previous_quarter_end")
    assert row["previous_quarter_end"] == date(2026, 3, 31)
    assert (row["forecast_day"], row["forecast_seq"]) == (date(2026, 5, 8), 1)


def test_missing_date_context_fails(rows):
    with pytest.raises(ValueError, match="No date context row"):
        snapshots.require_context(context(rows, date(2026, 5, 12), [
            (date(2026, 5, 8), 1, 7)]), "day")
    with pytest.raises(ValueError, match="No date context row"):
        snapshots.require_context(context(rows, date(2026, 5, 11), [
            (date(2026, 5, 12), 1, 7)]), "day")
    with pytest.raises(ValueError, match="no value for v"):
        snapshots.require_context(rows([(1, None)], "k int, v int"), "v")


def test_query_over_named_tables(spark, rows):
    df = rows([(1,), (3,)], "v int")
    assert snapshots.read_query(spark, "select max(v) m from {t}", t=df).first()["m"] == 3


def test_delimited_files_by_pattern(spark, tmp_path):
    (tmp_path / "rates 1.csv").write_text("CODE;RATE;DATE\nUSD;1.5;2026-03-31\n")
    (tmp_path / "rates 2.csv").write_text("CODE;RATE;DATE\nEUR;;2026-03-31\n")
    (tmp_path / "other.csv").write_text("x\n1\n")
    names = "code string, rate double, day date"
    with pytest.raises(ValueError, match="The header has"):
        feeds.read_delimited(spark, str(tmp_path), names, "rates*.csv", delimiter=";")
    df = feeds.read_delimited(spark, str(tmp_path), names, "rates*.csv", delimiter=";", positional=True)
    assert as_tuples(df) == [("EUR", None, date(2026, 3, 31)), ("USD", 1.5, date(2026, 3, 31))]


@pytest.mark.parametrize("kind, low, high", [
    ("int", 1, 2), ("bigint", 1, 2), ("double", 1.0, 2.0), ("string", "a", "b"),
    ("date", date(2026, 1, 1), date(2026, 1, 2))])
def test_incremental_rows(rows, kind, low, high):
    source = rows([(low,), (high,), (None,)], f"w {kind}")
    loaded = rows([(low,)], f"w {kind}")
    assert as_tuples(feeds.incremental_rows(source, loaded, "w")) == [(high,)]
    assert feeds.incremental_rows(source, loaded.where("false"), "w").count() == 2


def test_rows_since_a_stamp_are_pushed_to_the_source(spark, rows, tmp_path):
    loaded = rows([(date(2026, 1, 1),), (date(2026, 1, 3),)], "w date")
    path = str(tmp_path / "source")
    rows([(date(2026, 1, d),) for d in (2, 3, 4)], "w date").write.parquet(path)
    source = spark.read.parquet(path)
    stamp = feeds.newest_stamp(loaded, "w")
    found = feeds.rows_since(source, "w", stamp)
    assert as_tuples(found) == [(date(2026, 1, 4),)]
    assert "GreaterThan(w,2026-01-03)" in found._jdf.queryExecution().executedPlan().toString()
    assert feeds.newest_stamp(loaded.where("false"), "w") is None
    assert feeds.rows_since(source, "w", None).count() == 3


def test_incremental_rows_rejects_odd_watermarks(rows):
    df = rows([(True,)], "w boolean")
    with pytest.raises(ValueError):
        feeds.incremental_rows(df, df, "w")


def test_active_dimension(rows):
    a = rows([("p", 1, 1), ("q", 2, 1), ("r", 1, 0), ("s", 3, 1)], "name string, k int, a int")
    b = rows([(1, "USD", 1), (2, None, 1), (3, "EUR", 0)], "ck int, code string, b int")
    found = feeds.active_dimension(a, b, F.col("k") == F.col("ck"),
                                   [F.col("a") == 1, F.col("b") == 1], ["code"])
    assert [r["name"] for r in found.collect()] == ["p"]


def test_audit_columns_per_kind(rows):
    now = F.lit("2026-05-12 02:30:00").cast("timestamp")
    made = {k: sinks.add_audit_columns(rows([(1,)], "v int"), k, now, "America/New_York",
                                       reporting_date=date(2026, 3, 31),
                                       valuation_date=date(2026, 5, 8)) for k in sinks.KINDS}
    stamp = made["stress"].select(F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm")).first()[0]
    assert stamp == "2026-05-11 22:30"
    assert made["stress"].columns == ["v", "ingestion_ts", "run_date"]
    assert made["reporting"].first()["run_date"] == date(2026, 5, 11)
    assert made["reporting"].first()["reporting_date"] == date(2026, 3, 31)
    assert made["forecasting"].first()["forecast_date"] == date(2026, 5, 11)
    assert made["daily_forecasting"].first()["forecast_date"] == date(2026, 5, 8)
    with pytest.raises(ValueError):
        sinks.add_audit_columns(rows([(1,)], "v int"), "weekly", now, "UTC")


def test_audit_kind_by_table_name():
    rules = [(["report"], sinks.REPORTING), (["forecast", "daily"], sinks.DAILY_FORECASTING),
             (["forecast"], sinks.FORECASTING)]
    assert sinks.audit_kind("x_forecast_daily", rules) == sinks.DAILY_FORECASTING
    assert sinks.audit_kind("x_forecast", rules) == sinks.FORECASTING
    with pytest.raises(ValueError, match="No audit rule"):
        sinks.audit_kind("other", rules)


def test_write_appends_and_partitions(spark, rows, tmp_path):
    target = str(tmp_path / "losses")
    df = rows([(1, "a"), (2, "b")], "v int, p string")
    sinks.write_table(df, target, partition_by="p")
    sinks.write_table(df, target, partition_by="p")
    back = snapshots.read_table(spark, target)
    assert as_tuples(back.select("v", "p")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    plan = back.where("p = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    sinks.write_table(df, target + "2", mode="overwrite")
    assert spark.read.parquet(target + "2").count() == 2


def test_staged_tables_know_their_size(spark):
    staged = staging.stage(spark.range(10), "ten")
    assert (staged.rows, staged.bytes) == (10, 80)
    assert staged.fits(10) and not staged.fits(9)
    wide = staging.stage(spark.range(70).select(F.repeat(F.lit("x"), 1_000_000).alias("s"),
                                                F.lit(None).cast("string").alias("n")), "wide")
    assert wide.bytes == 70 * (1_000_000 + 16) and not wide.fits()
    assert staging.shared_folder(spark) in staged.df.inputFiles()[0]
    assert staging.stage(spark.range(0), "none").df.count() == 0


class Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(settings.get),
                                      "set": staticmethod(settings.__setitem__)})


def test_shared_folder_is_named_by_the_session():
    named = Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert staging.shared_folder(named) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="shared by all executors"):
        staging.shared_folder(Session("spark://host:7077", {}))
    local = Session("local[2]", {})
    assert staging.shared_folder(local) == staging.shared_folder(local)


def test_delimited_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("RATE_B,RATE_A\n2.0,1.0\n")
    rows = feeds.read_delimited(spark, str(tmp_path), "rate_a double, rate_b double")
    assert rows.columns == ["rate_a", "rate_b"] and tuple(rows.first()) == (1.0, 2.0)
    with pytest.raises(ValueError, match="The header has"):
        feeds.read_delimited(spark, str(tmp_path), "rate_a double, other double")


def test_every_file_has_the_header_of_the_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform|FAILED_READ_FILE|header"):
        feeds.read_delimited(spark, str(tmp_path), "a int, b int").collect()


def test_watermark_names_match_in_any_case(spark):
    source = spark.createDataFrame([(1,), (3,)], "Ingestion_TS int")
    assert feeds.incremental_rows(source, source.limit(1), "INGESTION_TS").count() == 1
