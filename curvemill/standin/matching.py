"""Check queries: as-of joins and rules that are rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.calendar import quarter_end
from curvemill.operators import asof
from curvemill.operators.rules import match_rules as first_rule
from curvemill.standin.registry import Tables, check


@check("""
WITH rates AS (
  SELECT CASE WHEN l_orderkey % 50 = 1 THEN NULL WHEN l_suppkey % 2 = 0 THEN 'EUR'
              ELSE 'C' || CAST(l_suppkey % 5 AS VARCHAR) END AS currency,
         CAST(l_shipdate AS DATE) AS rate_day, CASE WHEN l_quantity >= 5 THEN l_discount END AS rate,
         l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem WHERE l_partkey % 7 = 0),
one AS (SELECT currency, rate_day, max(seq) AS seq FROM rates WHERE currency IS NOT NULL GROUP BY ALL),
picked AS (SELECT one.*, rate FROM one JOIN rates USING (currency, rate_day, seq)),
asked AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'EUR' WHEN o_custkey % 11 = 0 THEN NULL
                          ELSE 'C' || CAST(o_custkey % 7 AS VARCHAR) END AS currency,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)
SELECT o_orderkey, asked.currency, day, rate_day, rate
FROM asked ASOF LEFT JOIN picked ON asked.currency = picked.currency AND day >= rate_day""")
def rate_as_of_date(t: Tables) -> DataFrame:
    """Rates with gaps, ties and nulls; one currency holds half of all rows."""
    def code(number: str, other: int, missing):
        text = F.concat(F.lit("C"), (F.col(number) % other).cast("string"))
        return F.when(missing, None).when(F.col(number) % 2 == 0, F.lit("EUR")).otherwise(text)

    rates = t.lineitem.where("l_partkey % 7 = 0").select(
        code("l_suppkey", 5, F.col("l_orderkey") % 50 == 1).alias("currency"),
        F.col("l_shipdate").cast("date").alias("rate_day"),
        F.when(F.col("l_quantity") >= 5, F.col("l_discount")).alias("rate"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    missing = (F.col("o_custkey") % 2 != 0) & (F.col("o_custkey") % 11 == 0)
    asked = t.orders.select(
        "o_orderkey", code("o_custkey", 7, missing).alias("currency"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate").cast("date")).alias("day"))
    return asof.as_of_join(asked, rates, ["currency"], "day", "rate_day", ["rate_day", "rate"], ["seq"])


@check("""
WITH days AS (SELECT DISTINCT last_day(o_orderdate) AS month_end FROM orders),
sets AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
         WHERE o_totalprice >= 450000 AND month(o_orderdate) % 3 = 0
               AND CAST(o_orderdate AS DATE) = last_day(o_orderdate)),
goal AS (SELECT month_end, last_day(CAST(date_trunc('quarter', month_end) AS DATE)
                                    + INTERVAL 2 MONTH) AS quarter FROM days)
SELECT month_end, CASE WHEN quarter IN (SELECT day FROM sets) THEN quarter
                       ELSE (SELECT max(day) FROM sets WHERE day <= month_end) END AS effective_date
FROM goal""")
def shock_set_as_of(t: Tables) -> DataFrame:
    days = t.orders.select(F.last_day("o_orderdate").alias("month_end")).distinct()
    day = F.col("o_orderdate").cast("date")
    sets = t.orders.where((F.col("o_totalprice") >= 450000) & (day == quarter_end(day))) \
        .select(day.alias("effective_date"))
    return asof.shock_set_as_of(days, sets, "month_end", "effective_date")


@check("""
WITH rules AS (
  SELECT p_partkey AS rule, 'exact' AS form, p_name AS pattern, NULL AS scope,
         'name of ' || CAST(p_partkey AS VARCHAR) AS result FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 'suffix', right(p_name, 1 + p_partkey % 4),
         CASE WHEN p_partkey % 2 = 0 THEN p_brand END, 'end of ' || CAST(p_partkey AS VARCHAR)
  FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT 1000000 + max(p_partkey), 'default', NULL, p_brand, 'other ' || p_brand
  FROM part WHERE p_size < 25 GROUP BY p_brand)
SELECT p_partkey, p_name, p_brand, (
  SELECT arg_min(result, (rule, result)) FROM rules
  WHERE (scope IS NULL OR scope = p_brand)
    AND (form = 'default' OR form = 'exact' AND pattern = p_name
         OR form = 'suffix' AND suffix(p_name, pattern))) AS found
FROM part""")
def rules_of_a_table(t: Tables) -> DataFrame:
    """As many rules as parts: names, ends of names within a brand or in all, and defaults."""
    key, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    exact = t.part.where(key % 3 == 0).select(
        key.alias("rule"), F.lit("exact").alias("form"), F.col("p_name").alias("pattern"),
        F.lit(None).cast("string").alias("scope"), F.concat(F.lit("name of "), text).alias("result"))
    suffix = t.part.where(key % 5 == 0).select(
        key, F.lit("suffix"), F.right("p_name", (1 + key % 4).cast("int")),
        F.when(key % 2 == 0, F.col("p_brand")), F.concat(F.lit("end of "), text))
    default = t.part.where("p_size < 25").groupBy("p_brand").agg(F.max("p_partkey").alias("last")).select(
        F.col("last") + 1000000, F.lit("default"), F.lit(None).cast("string"), F.col("p_brand"),
        F.concat(F.lit("other "), "p_brand"))
    rules = exact.union(suffix).union(default)
    return first_rule(t.part.select("p_partkey", "p_name", "p_brand"), rules, "p_name", "found", "p_brand")
