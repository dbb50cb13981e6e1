"""Check queries: snapshots, literal lookups, dates on file, feeds and audit columns."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.calendar import quarter_end, refresh_due
from curvemill.operators.lookups import lookup
from curvemill.operators.shaping import tagged_union
from curvemill.sources import sinks
from curvemill.sources import snapshots
from curvemill.operators.lookups import unparsed_dates
from curvemill.operators.quality import empty_inputs as empty_report
from curvemill.sources.feeds import active_dimension, read_delimited, rows_if_due
from curvemill.sources.feeds import incremental_rows as newer_rows
from curvemill.staging import shared_folder
from curvemill.standin.registry import Tables, check

DESKS = [("1-URGENT", "F", "rush"), ("1-URGENT", "O", "rush"), ("2-HIGH", "F", "day"),
         ("5-LOW", "P", "night"), ("5-LOW", "P", "night")]
CLOCK = "2026-05-11 22:30:00"
ZONE = "America/New_York"


@check("""
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderdate =
  (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')""")
def latest_snapshot(t: Tables) -> DataFrame:
    return snapshots.latest_snapshot(t.orders, "o_orderstatus = 'F'", "o_orderdate")


@check("""
SELECT o_orderkey, o_orderpriority, o_orderstatus, desk FROM orders LEFT JOIN
  (VALUES ('1-URGENT', 'F', 'rush'), ('1-URGENT', 'O', 'rush'), ('2-HIGH', 'F', 'day'),
          ('5-LOW', 'P', 'night')) m(priority, status, desk)
ON o_orderpriority = priority AND o_orderstatus = status""")
def literal_lookup(t: Tables) -> DataFrame:
    desks = snapshots.literal_rows(t.spark, DESKS,
                                   "priority string, status string, desk string")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return lookup(orders, desks, {"priority": "o_orderpriority",
                                  "status": "o_orderstatus"}, ["desk"])


@check("""
WITH days AS (SELECT DISTINCT last_day(o_orderdate) AS month_end FROM orders),
sets AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
         WHERE o_totalprice >= 450000 AND month(o_orderdate) % 3 = 0
               AND CAST(o_orderdate AS DATE) = last_day(o_orderdate)),
goal AS (SELECT month_end, last_day(CAST(date_trunc('quarter', month_end) AS DATE)
                                    + INTERVAL 2 MONTH) AS quarter FROM days)
SELECT month_end,
       CASE WHEN quarter IN (SELECT day FROM sets) THEN quarter
            ELSE (SELECT max(day) FROM sets) END AS effective_date,
       CASE WHEN quarter IN (SELECT day FROM sets) THEN quarter
            ELSE (SELECT max(day) FROM sets WHERE day <= month_end) END AS not_after
FROM goal""")
def shock_set_for_date(t: Tables) -> DataFrame:
    days = t.orders.select(F.last_day("o_orderdate").alias("month_end")).distinct()
    day = F.col("o_orderdate").cast("date")
    sets = t.orders.where((F.col("o_totalprice") >= 450000) & (day == quarter_end(day))) \
        .select(day.alias("effective_date"))
    plain = snapshots.shock_set_for_date(days, sets, "month_end", "effective_date")
    late = sets.withColumnRenamed("effective_date", "not_after")
    return snapshots.shock_set_for_date(plain, late, "month_end", "not_after", True)


CONTEXT_SQL = """
WITH today AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)
SELECT a.*, b.* FROM
 (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS date_key, o_orderstatus AS status
  FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
    AND CAST(o_orderdate AS DATE) = (SELECT d FROM today) ORDER BY o_orderkey LIMIT 1) a,
 (SELECT max(CAST(l_shipdate AS DATE)) AS forecast_day FROM lineitem
  WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)
    AND CAST(l_shipdate AS DATE) <= (SELECT d FROM today)) b
WHERE forecast_day IS NOT NULL"""


@check(CONTEXT_SQL)
def date_context(t: Tables) -> DataFrame:
    dates = t.orders.select(F.col("o_orderdate").cast("date").alias("day"),
                            F.col("o_orderkey").alias("date_key"),
                            F.col("o_orderstatus").alias("status"),
                            F.year("o_orderdate").alias("ingestion_ts"))
    forecasts = t.lineitem.select(F.col("l_shipdate").cast("date").alias("forecast_day"),
                                  F.year("l_shipdate").alias("ingestion_ts"))
    today = snapshots.read_query(t.spark, "select max(day) as day from {dates}",
                                 dates=dates).scalar()
    return snapshots.date_context(dates, forecasts, today, day="day",
                                  forecast_day="forecast_day", order=["date_key"])


@check(CONTEXT_SQL)
def required_context(t: Tables) -> DataFrame:
    """The context row that a job goes on with; it fails where there is none."""
    context = date_context(t)
    row = snapshots.require_context(context, "forecast_day")
    return t.spark.createDataFrame([row], context.schema)


@check("""
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events
                                 WHERE ts < TIMESTAMP '2024-01-20 00:00:00')""")
def incremental_rows(t: Tables) -> DataFrame:
    loaded = t.events.where("ts < timestamp_ntz'2024-01-20 00:00:00'")
    return newer_rows(t.events, loaded, "ts")


@check("""
SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_acctbal > 0 AND n_regionkey <> 3 AND n_name IS NOT NULL""")
def active_dimension_join(t: Tables) -> DataFrame:
    joined = active_dimension(
        t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey"),
        [F.col("s_acctbal") > 0, F.col("n_regionkey") != 3], ["n_name"])
    return joined.select("s_suppkey", "s_name", "n_name")


@check("""
WITH stamped AS (SELECT o_orderkey, TIMESTAMP '2026-05-11 18:30:00' AS ts FROM orders)
SELECT o_orderkey, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingestion_ts,
       CASE WHEN kind <> 'stress' THEN DATE '2026-03-31' END AS reporting_date,
       CASE kind WHEN 'forecasting' THEN CAST(ts AS DATE)
                 WHEN 'daily_forecasting' THEN DATE '2026-05-08' END AS forecast_date,
       CAST(ts AS DATE) AS run_date
FROM stamped, (VALUES ('reporting'), ('forecasting'), ('daily_forecasting'), ('stress')) k(kind)""")
def audit_columns(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey")
    now = F.lit(CLOCK).cast("timestamp")
    kinds = {kind: sinks.add_audit_columns(rows, kind, now, ZONE,
                                           reporting_date=date(2026, 3, 31),
                                           valuation_date=date(2026, 5, 8))
             for kind in sinks.KINDS}
    day = F.lit(None).cast("date")
    full = {k: d.withColumns({c: day for c in ("reporting_date", "forecast_date")
                              if c not in d.columns}) for k, d in kinds.items()}
    return tagged_union(full, "kind").withColumn(
        "ingestion_ts", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss"))


@check("""
WITH loads AS (SELECT c_custkey, max(CAST(o_orderdate AS DATE)) AS last_load
               FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_custkey, last_load,
       last_load IS NULL OR last_load < DATE '2001-07-15' AS daily,
       last_load IS NULL OR date_trunc('month', last_load) < DATE '2001-07-01' AS monthly,
       last_load IS NULL OR date_trunc('quarter', last_load) < DATE '2001-07-01' AS quarterly,
       last_load IS NULL OR last_load < DATE '2001-07-01' AS half_yearly,
       last_load IS NULL OR last_load < DATE '2001-01-01' AS yearly
FROM loads""")
def dimension_refresh_due(t: Tables) -> DataFrame:
    newest = t.orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").cast("date").alias("last_load"))
    loads = t.customer.select("c_custkey").join(
        newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    today = F.lit(date(2001, 7, 15))
    names = {"daily": "daily", "monthly": "monthly", "quarterly": "quarterly",
             "half_yearly": "semi-annually", "yearly": "annually"}
    return loads.select("c_custkey", "last_load", *[
        refresh_due("last_load", today, f).alias(n) for n, f in names.items()])


@check("""
WITH loads AS (SELECT max(CAST(o_orderdate AS DATE)) AS last_load FROM orders)
SELECT 'later day' AS today, c_custkey, c_name FROM customer, loads
WHERE last_load < DATE '2001-07-15'
UNION ALL SELECT 'same day', c_custkey, c_name FROM customer, loads WHERE last_load < last_load
UNION ALL SELECT 'no load yet', c_custkey, c_name FROM customer
WHERE (SELECT max(o_orderdate) FROM orders WHERE o_totalprice < 0) IS NULL""")
def refresh_if_due(t: Tables) -> DataFrame:
    """A dimension is loaded whole when its refresh is due, else not at all."""
    loads = t.orders.select("o_totalprice", F.col("o_orderdate").alias("ingestion_ts"))
    last = loads.agg(F.max("ingestion_ts").cast("date")).scalar()
    source = t.customer.select("c_custkey", "c_name")
    return tagged_union({
        "later day": rows_if_due(source, loads, "daily", F.lit(date(2001, 7, 15))),
        "same day": rows_if_due(source, loads, "daily", last),
        "no load yet": rows_if_due(source, loads.where("o_totalprice < 0"), "annually", last),
    }, "today")


@check("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t: Tables) -> DataFrame:
    """Written with a header in another order and case, read back under the schema."""
    folder = f"{shared_folder(t.spark)}/csv-{uuid.uuid4().hex}"
    t.customer.select(F.col("c_mktsegment").alias("C_MKTSEGMENT"), "c_acctbal", "c_custkey",
                      "c_name").write.option("header", True).csv(folder)
    names = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    kinds = dict(t.customer.dtypes)
    return read_delimited(t.spark, folder, ", ".join(f"{n} {kinds[n]}" for n in names))


@check("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def partitioned_round_trip(t: Tables) -> DataFrame:
    folder = f"{shared_folder(t.spark)}/orders-{uuid.uuid4().hex}"
    sinks.write_table(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), folder,
                      partition_by="o_orderstatus")
    return snapshots.read_table(t.spark, folder)


@check("""
SELECT 'orders' AS input, count(*) = 0 AS is_empty FROM orders
UNION ALL SELECT 'free orders', count(*) = 0 FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'events', count(*) = 0 FROM events""")
def empty_inputs(t: Tables) -> DataFrame:
    return empty_report({"orders": t.orders, "free orders": t.orders.where("o_totalprice < 0"),
                         "events": t.events})


@check("""
WITH given AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'day ' || o_orderpriority
                           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT day, count(*) AS n FROM given WHERE day LIKE 'day %' GROUP BY day""")
def unparsed_rates(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("day "), "o_orderpriority")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return unparsed_dates(t.orders.select(day.alias("day")), "day", "yyyy-MM-dd", "n")
