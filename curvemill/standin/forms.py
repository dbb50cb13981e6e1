"""Check queries: column shaping, unpivots and unions, fills and calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions import calendar as cal
from curvemill.functions.amounts import from_units, total, units, zero_if_null
from curvemill.functions.keys import clean_code
from curvemill.operators import shaping
from curvemill.operators.curves import (
    curve_points, curve_rows, curve_totals, unpivot_curve, wide_curve_rows, zero_tenors)
from curvemill.standin.registry import Tables, check

UNPIVOT_SQL = """
SELECT l_returnflag, tenor_years, sum(v) AS total FROM (
  SELECT l_returnflag, CAST(0.25 AS DOUBLE) AS tenor_years,
         CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem
  UNION ALL SELECT l_returnflag, 0.5, CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
  UNION ALL SELECT l_returnflag, 1.0, coalesce(CAST(nullif(l_tax, 0) AS DECIMAL(18,2)), 0)
  FROM lineitem) GROUP BY ALL""".replace("sum(v)", "CAST(sum(v) AS DOUBLE)")


def wide_lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", F.col("l_quantity").alias("003M"),
                             F.col("l_extendedprice").alias("006M"),
                             F.nullif("l_tax", F.lit(0.0)).alias("012M"))


@check(UNPIVOT_SQL, "unpivot_curve")
def unpivot_totals(t: Tables) -> DataFrame:
    rows = unpivot_curve(wide_lines(t), ["l_returnflag"]) \
        .withColumn("value", zero_if_null("value"))
    return curve_totals(rows, ["l_returnflag", "tenor_years"], "value", "total", 2)


@check(UNPIVOT_SQL)
def wide_curve_totals(t: Tables) -> DataFrame:
    rows, tenors = wide_curve_rows(zero_tenors(wide_lines(t)), ["l_returnflag"], "e", 2)
    return curve_points(rows, ["l_returnflag"], tenors, "emask", "tenor_years",
                        {"e": "total"})


MONTHS = list(range(1, 121))


@check("""
SELECT l_returnflag, month / 12 AS tenor_years, total FROM (
  SELECT l_returnflag, CAST((year(l_shipdate) * 12 + month(l_shipdate)) % 120 + 1 AS INTEGER)
           AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY ALL)""")
def monthly_curves(t: Tables) -> DataFrame:
    """Curves of monthly tenors, more than a single mask column holds."""
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")) % 120 + 1
    rows = t.lineitem.select("l_returnflag", month.alias("month"),
                             units("l_extendedprice").alias("cents"))
    rows = curve_rows(rows, ["l_returnflag"], "month", "cents", MONTHS, "e")
    return curve_points(rows, ["l_returnflag"], MONTHS, "emask", "tenor_years", {"e": "cents"}) \
        .select("l_returnflag", "tenor_years", from_units("cents").alias("total"))


@check("""
SELECT l_returnflag AS program_code, l_linenumber AS legal_id, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY ALL""", "union_feeds")
def feed_totals(t: Tables) -> DataFrame:
    def feed(flag: str, *order: str) -> DataFrame:
        code = F.concat(F.lit(" "), F.lower("l_returnflag"), F.lit("  "))
        return t.lineitem.where(F.col("l_returnflag") == flag).select(
            code.alias("program_code"), F.col("l_linenumber").cast("string").alias("legal_id"),
            F.col("l_extendedprice").alias("value")).select(*order)

    rows = shaping.union_feeds([feed("A", "program_code", "legal_id", "value"),
                                feed("R", "value", "legal_id", "program_code"),
                                feed("N", "legal_id", "program_code", "value")])
    rows = rows.withColumns({"program_code": clean_code("program_code"),
                             "legal_id": F.col("legal_id").try_cast("int")})
    return rows.groupBy("program_code", "legal_id").agg(
        F.count(F.lit(1)).alias("n"), total("value", 2).alias("total"))


@check("""
SELECT p_partkey AS "PART_KEY", p_brand AS "BRAND_NAME", TRY_CAST(replace(p_brand, 'Brand#', '')
       AS INTEGER) AS "BRAND_CODE", CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS "PRICE",
       TRY_CAST(p_type AS DATE) AS "TYPE_DATE", 'Risk Free' AS "RATE_TYPE",
       CAST(NULL AS VARCHAR) AS "NOTE"
FROM part""")
def shape_columns(t: Tables) -> DataFrame:
    df = shaping.require_columns(t.part, ["P_PARTKEY", "p_brand"])
    df = df.withColumns({"brand code": F.replace("p_brand", F.lit("Brand#"), F.lit("")),
                         "Type Date": F.col("p_type")})
    df = shaping.rename_columns(df, ["p_partkey", "p_brand", "p_retailprice"],
                                ["part key ", "brand/name", "price"])
    df = df.drop("p_name", "p_size", "p_type")
    df = shaping.add_constants(df, {"rate type": "Risk Free", "note": None})
    df = shaping.override_types(df, {"brand code": "int", "price": "decimal(12,2)",
                                     "Type Date": "date"})
    df = df.withColumn("price", F.col("price").cast("string"))
    return shaping.normalize_names(df)


@check("SELECT p_type AS party_type, p_retailprice AS amount FROM part")
def positional_columns(t: Tables) -> DataFrame:
    return shaping.name_positions(t.part, [3, 5], ["party_type", "amount"])


FILL_SQL = """
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS click_value FROM events"""


def fill_clicks(t: Tables, piece: str) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", F.when(
        F.col("event_type") == "click", F.col("value")).alias("click_value"))
    return shaping.forward_fill(rows, ["click_value"], ["ts", "event_id"],
                                F.date_trunc(piece, "ts"), ["user_id"]).drop("ts")


@check(FILL_SQL)
def forward_fill(t: Tables) -> DataFrame:
    return fill_clicks(t, "month")


@check(FILL_SQL)
def forward_fill_in_pieces(t: Tables) -> DataFrame:
    """The same in many small pieces."""
    return fill_clicks(t, "minute")


@check("""
SELECT * FROM events WHERE event_type IS NULL OR event_type NOT IN ('view', 'error')""")
def exclude_values(t: Tables) -> DataFrame:
    return shaping.exclude_values(t.events, "event_type", ["view", "error"])


@check("""
SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS balance, 'customer' AS party
FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def tagged_union(t: Tables) -> DataFrame:
    return shaping.tagged_union({
        "customer": t.customer.select(F.col("c_custkey").alias("party_key"),
                                      F.col("c_name").alias("name"),
                                      F.col("c_acctbal").alias("balance")),
        "supplier": t.supplier.select(F.col("s_acctbal").alias("balance"),
                                      F.col("s_suppkey").alias("party_key"),
                                      F.col("s_name").alias("name")),
    }, "party")


def order_days(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()


DAYS_SQL = "WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"


@check(f"""{DAYS_SQL}
SELECT day, isodow(day) > 5 AS weekend, isodow(day) < 6 AS business_day,
  last_day(day - INTERVAL 1 MONTH) AS last_month_end,
  CAST(day(last_day(day - INTERVAL 1 MONTH)) AS INTEGER) AS last_month_end_day,
  CAST(date_trunc('quarter', day) - INTERVAL 1 DAY AS DATE) AS last_quarter_end,
  CAST(day(date_trunc('quarter', day) - INTERVAL 1 DAY) AS INTEGER) AS last_quarter_end_day,
  last_day(date_trunc('quarter', day) + INTERVAL 2 MONTH) AS quarter_end,
  CAST(day(last_day(date_trunc('quarter', day) + INTERVAL 2 MONTH)) AS INTEGER)
    AS quarter_end_day,
  CAST(date_trunc('month', day) + INTERVAL 1 MONTH AS DATE) AS next_month_start,
  last_day(day - INTERVAL 1 MONTH) AS report_date
FROM days""")
def calendar_columns(t: Tables) -> DataFrame:
    return order_days(t).withColumns({
        "weekend": cal.is_weekend("day"), "business_day": cal.is_business_day("day"),
        "last_month_end": cal.last_month_end("day"),
        "last_month_end_day": F.day(cal.last_month_end("day")),
        "last_quarter_end": cal.last_quarter_end("day"),
        "last_quarter_end_day": F.day(cal.last_quarter_end("day")),
        "quarter_end": cal.quarter_end("day"),
        "quarter_end_day": F.day(cal.quarter_end("day")),
        "next_month_start": cal.next_month_start("day"),
        "report_date": cal.report_date("day")})


@check("""
WITH months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month
                FROM orders),
days AS (SELECT month, CAST(month + CAST(i AS INTEGER) AS DATE) AS day
         FROM months, generate_series(1, 60) s(i)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY day) AS n
             FROM days WHERE isodow(day) < 6)
SELECT month, CAST(n AS INTEGER) AS n, day AS business_date FROM numbered
WHERE n IN (1, 3, 5, 10, 21, 26)""")
def nth_business_date(t: Tables) -> DataFrame:
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("month")).distinct()
    wanted = months.withColumn("n", F.explode(F.array(*map(F.lit, (1, 3, 5, 10, 21, 26)))))
    return wanted.withColumn("business_date", cal.nth_business_date("month", F.col("n")))


@check(f"""{DAYS_SQL},
codes AS (SELECT day, strftime(day, '%Y%m%d') AS day_text,
                 strftime(day, '%y') || 'Q' || quarter(day) AS quarter_code FROM days)
SELECT *, quarter_code || 'FC' || strftime(day, '%m%d') AS forecast_code,
  CAST(strptime(day_text, '%Y%m%d') AS DATE) AS day_back,
  last_day(date_trunc('quarter', day) + INTERVAL 2 MONTH) AS quarter_back,
  CASE WHEN year(day) < 2000 THEN CAST(day + INTERVAL 100 YEAR AS DATE) ELSE day END
    AS forecast_back
FROM codes""".replace("last_day(date_trunc('quarter', day) + INTERVAL 2 MONTH) AS quarter_back",
                      """last_day(CASE WHEN year(day) < 2000 THEN date_trunc('quarter', day)
    + INTERVAL 100 YEAR ELSE date_trunc('quarter', day) END + INTERVAL 2 MONTH)
    AS quarter_back"""))
def quarter_and_forecast_codes(t: Tables) -> DataFrame:
    return order_days(t).withColumns({
        "day_text": cal.date_to_text("day"), "quarter_code": cal.quarter_code("day"),
        "forecast_code": cal.forecast_code("day")}).withColumns({
            "day_back": cal.text_to_date("day_text"),
            "quarter_back": cal.quarter_code_to_date("quarter_code"),
            "forecast_back": cal.forecast_code_to_date("forecast_code")})
