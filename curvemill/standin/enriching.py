"""Check queries: newest rows, rates, normalised joins, classes and key reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import base_rate
from curvemill.functions.keys import classify, classify_rules, concat_key, normalize_text, recode
from curvemill.operators import lookups
from curvemill.operators import quality
from curvemill.operators.lookups import lookup
from curvemill.sources.snapshots import literal_rows
from curvemill.staging import stage
from curvemill.standin.registry import Tables, check

TAXES = [(" building ", 0.2), ("FURNITURE", 0.28), ("House\thold", 0.1), ("MACHinery", 0.15)]


@check("""
SELECT c_custkey, c_mktsegment, tax_rate FROM customer LEFT JOIN
  (VALUES ('building', 0.2), ('furniture', 0.28), ('house hold', 0.1), ('machinery', 0.15))
  v(name, tax_rate) ON lower(c_mktsegment) = name""".replace("0.2)", "CAST(0.2 AS DOUBLE))"))
def normalized_join(t: Tables) -> DataFrame:
    taxes = literal_rows(t.spark, TAXES, "name string, tax_rate double") \
        .withColumn("name", normalize_text("name"))
    return lookup(t.customer.select("c_custkey", "c_mktsegment"), taxes,
                  {"name": normalize_text("c_mktsegment")}, ["tax_rate"])


@check("""
SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
WHERE n = 1""")
def newest_dimension_row(t: Tables) -> DataFrame:
    return lookups.newest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@check("""
SELECT * EXCLUDE n FROM (SELECT *, dense_rank() OVER (
  PARTITION BY lower(o_orderpriority) ORDER BY o_orderdate DESC) AS n FROM orders)
WHERE n = 1""")
def newest_rows_with_ties(t: Tables) -> DataFrame:
    return lookups.newest_with_ties(t.orders, [normalize_text("o_orderpriority")],
                                    "o_orderdate")


@check("""
WITH closing AS (
  SELECT event_type, CAST(ts AS DATE) AS day, value AS fx_rate, row_number() OVER (
    PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, value DESC) AS n FROM events)
SELECT event_id, upper(e.event_type) AS event_type, CAST(ts AS DATE) AS day, value, fx_rate
FROM events e LEFT JOIN closing c
ON e.event_type = c.event_type AND CAST(ts AS DATE) = c.day AND n = 1""")
def newest_rate_per_date(t: Tables) -> DataFrame:
    rates = stage(lookups.rates_by_date(t.events, "event_type", "value", "ts",
                                        "yyyy-MM-dd", "ts"), "rates")
    rows = t.events.select("event_id", F.upper("event_type").alias("event_type"),
                           F.col("ts").cast("date").alias("day"), "value")
    return lookup(rows, rates, {"fx_currency": "event_type", "fx_date": "day"}, ["fx_rate"])


@check("""
SELECT c_custkey, n_regionkey AS currency,
       CASE WHEN n_regionkey = 0 AND fx IS NULL THEN 1.0 ELSE fx END AS fx_rate
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN
  (VALUES (1, CAST(1.25 AS DOUBLE)), (2, 0.5), (3, 0.75)) r(code, fx) ON n_regionkey = code""")
def rate_with_base_default(t: Tables) -> DataFrame:
    rates = literal_rows(t.spark, [(1, 1.25), (2, 0.5), (3, 0.75)],
                         "code int, fx_rate double")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_regionkey").alias("currency"))
    return lookup(rows, rates, {"code": "currency"}, ["fx_rate"]) \
        .withColumn("fx_rate", base_rate("fx_rate", "currency", 0))


@check("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Bond'
  WHEN c_mktsegment = 'BUILDING' THEN 'Liability' WHEN c_mktsegment = 'FURNITURE' THEN 'Bank'
  END AS class FROM customer""")
def classify_codes(t: Tables) -> DataFrame:
    classes = {"Bond": ["AUTOMOBILE", "MACHINERY"], "Liability": ["BUILDING"],
               "Bank": ["FURNITURE"]}
    return t.customer.select("c_custkey", classify("c_mktsegment", classes).alias("class"))


@check("""
SELECT p_partkey, CASE WHEN p_name = 'red widget' THEN 'NAMED'
  WHEN upper(p_type) LIKE '%ALL' OR upper(p_brand) = 'BRAND#1' THEN 'SURPLUS'
  WHEN p_type = 'ECONOMY' THEN 'FIRST' WHEN p_type = 'PROMO' THEN 'SECOND'
  ELSE 'OTHER' END AS segment,
  CASE WHEN p_type = 'LARGE' THEN 'BIG' ELSE p_type END || p_brand AS segment_type
FROM part""")
def segment_rules(t: Tables) -> DataFrame:
    rules = [(F.col("p_name") == "red widget", "NAMED"),
             (F.upper("p_type").endswith("ALL") | (F.upper("p_brand") == "BRAND#1"), "SURPLUS"),
             (F.upper("p_type") == "ECONOMY", "FIRST"),
             (F.upper("p_type") == "PROMO", "SECOND")]
    return t.part.select(
        "p_partkey", classify_rules(rules, "OTHER").alias("segment"),
        concat_key(recode("p_type", {"LARGE": "BIG"}), "p_brand").alias("segment_type"))


@check("""
SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM (VALUES ('1-URGENT', 'F'), ('1-URGENT', 'O'), ('2-HIGH', 'F'), ('5-LOW', 'P'))
  m(p, s) WHERE p = o_orderpriority AND s = o_orderstatus)""")
def unmatched_keys(t: Tables) -> DataFrame:
    known = literal_rows(t.spark, [("1-URGENT", "F"), ("1-URGENT", "O"), ("2-HIGH", "F"),
                                   ("5-LOW", "P")], "priority string, status string")
    return quality.unmatched_keys(t.orders, known, {"o_orderpriority": "priority",
                                                    "o_orderstatus": "status"})


@check("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def lookup_key_duplicates(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("""
SELECT 'orders' AS input, 'rows' AS "check", count(*) AS found FROM orders
UNION ALL SELECT 'orders', 'unparsed_date', count(*) FROM orders
  WHERE try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%m-%d-%Y') IS NULL
UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem
UNION ALL SELECT 'lineitem', 'no_result', count(*) FROM lineitem
  WHERE l_extendedprice / nullif(l_tax, 0) IS NULL
UNION ALL SELECT 'events', 'rows', count(*) FROM events
UNION ALL SELECT 'events', 'no_value', count(*) FROM events WHERE value IS NULL""")
def input_report(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "dd-MM-yyyy")
    result = F.col("l_extendedprice") / F.nullif(F.col("l_tax"), F.lit(0.0))
    return quality.input_report({
        "orders": (t.orders, {"unparsed_date": F.try_to_date(text, "MM-dd-yyyy").isNull()}),
        "lineitem": (t.lineitem, {"no_result": result.isNull()}),
        "events": (t.events, {"no_value": F.col("value").isNull()}),
    })
