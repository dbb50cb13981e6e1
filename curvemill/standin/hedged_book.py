"""Check queries for the hedged book, run through the whole plan on wide feeds."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import from_units
from curvemill.plans import hedged
from curvemill.plans.hedged import HedgedInputs, HedgedRules
from curvemill.sources.snapshots import literal_rows
from curvemill.staging import stage
from curvemill.standin.book import SHOCK_SQL, TENORS, customers, per_customer, shock_points
from curvemill.standin.registry import Tables, check

CURRENCIES = ["xaa", " xbb", "xcc ", "Xdd", "xee"]
PROGRAMS = {"AUTOMOBILE": " pr_01", "BUILDING": "PR_02 ", "FURNITURE": "pr_03",
            "HOUSEHOLD": "Pr_04", "MACHINERY": "pr_05"}
QUARTER = date(2026, 3, 31)
RULES = HedgedRules(
    base_currency="XAA", quarter=QUARTER, scale=2,
    classes={"Liability": ["PR_01", "PR_02"], "Bond": ["PR_03", "PR_05"]},
    loss_columns={"Liability": "losses_liability", "Bond": "losses_bond"})
PORTFOLIO_MAP = [(f"PR_0{p}", n, f"X{'abcde'[n % 5] * 2}".upper(), f"Book {n % 7}")
                 for p in range(1, 5) for n in range(25)]
HIERARCHY = ([(f"BOOK  {i}", 20260331, 0.05 * (i + 1)) for i in range(6)]
             + [(f"book {i}", 20251231, 0.9) for i in range(7)])
RATES = [("xbb", 1.25, QUARTER, 1), ("XCC ", 0.5, QUARTER, 1), ("xdd", 0.75, QUARTER, 1),
         ("xbb", 9.5, QUARTER, 0), ("xdd", 3.5, date(2025, 12, 31), 2)]

NET_SQL = """
point AS (
  SELECT 'PR_0' || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
           WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS program_code,
         n_nationkey AS legal_id, 'X' || CASE n_regionkey WHEN 0 THEN 'AA' WHEN 1 THEN 'BB'
           WHEN 2 THEN 'CC' WHEN 3 THEN 'DD' ELSE 'EE' END AS security_currency,
         CAST(left(o_orderpriority, 1) AS DOUBLE) AS tenor_cd, l_returnflag AS flag,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
feed AS (
  SELECT DISTINCT k.program_code, k.legal_id, k.security_currency, k.flag, t.tenor_cd
  FROM (SELECT DISTINCT program_code, legal_id, security_currency, f.flag FROM point,
        (VALUES ('A'), ('N'), ('R')) f(flag)) k,
       (VALUES (1.0), (2.0), (3.0), (4.0), (5.0)) t(tenor_cd)
  WHERE NOT (flag = 'N' AND t.tenor_cd = 5) AND NOT (flag = 'A' AND t.tenor_cd = 5)),
total AS (
  SELECT feed.program_code, feed.legal_id, feed.security_currency,
         CAST(feed.tenor_cd AS DOUBLE) AS tenor_cd,
         CAST(sum(coalesce(price, 0)) AS DOUBLE) AS total_dv01
  FROM feed LEFT JOIN point USING (program_code, legal_id, security_currency, flag, tenor_cd)
  GROUP BY ALL),
rate AS (SELECT * FROM (VALUES ('XBB', CAST(1.25 AS DOUBLE)), ('XCC', 0.5), ('XDD', 0.75))
         v(security_currency, fx)),
partial AS (
  SELECT DATE '2026-03-31' AS report_date, security_currency,
         CASE WHEN program_code IN ('PR_01', 'PR_02') THEN 'Liability'
              WHEN program_code IN ('PR_03', 'PR_05') THEN 'Bond' END AS asset_holding,
         tenor_cd, program_code,
         CASE WHEN program_code <> 'PR_05' THEN 'Book ' || (legal_id % 7) END
           AS lowest_level_portfolio_name,
         CAST(legal_id AS INTEGER) AS legal_id, total_dv01,
         CASE WHEN security_currency = 'XAA' THEN 1.0 ELSE fx END AS fx_rate,
         CASE WHEN program_code <> 'PR_05' THEN CASE WHEN legal_id % 7 < 6
              THEN CAST(0.05 AS DOUBLE) * (legal_id % 7 + 1) ELSE CAST(0.9 AS DOUBLE) END END
           AS tax_rate
  FROM total LEFT JOIN rate USING (security_currency)),
net AS (SELECT *, total_dv01 * fx_rate * (1 - tax_rate) AS sum_partial_dv01 FROM partial)"""


def feeds(t: Tables) -> list[DataFrame]:
    """Three wide feeds, one per return flag; two of them lack the longest tenor."""
    cells = {f: f"lower(l_returnflag) = '{f}'" for f in "anr"}
    sums = per_customer(t, cells, TENORS)
    wide = (sums.join(customers(t), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("segment", "currency", "n_nationkey")
            .agg(*[from_units(F.sum(f"{c}{m}")).alias(f"{c}{m}")
                   for c in cells for m in TENORS]))
    wide = stage(wide, "feeds").df
    programs = F.create_map(*[F.lit(x) for pair in PROGRAMS.items() for x in pair])
    codes = F.array(*map(F.lit, CURRENCIES))
    keys = [F.lit("asset").alias("asset_type"), F.lit("2026-04-01").alias("inception_date"),
            programs[F.col("segment")].alias("program_code"),
            F.col("n_nationkey").cast("string").alias("legal_id"),
            F.element_at(codes, F.col("currency") + 1).alias("security_currency")]
    return [wide.select(*keys, F.lit(c).alias("source"), *[
        F.col(f"{c}{m}").alias(f"{m:03d}M") for m in (TENORS if c == "r" else TENORS[:4])])
        for c in cells]


def inputs(t: Tables) -> HedgedInputs:
    spark = t.spark
    shocks = shock_points(t).select(
        F.element_at(F.array(*map(F.lit, CURRENCIES)), F.col("currency") + 1)
        .alias("currency"), (F.col("tenor") / 12).alias("tenor"), "scenario",
        F.col("shock").alias("shocks"), F.lit(QUARTER).alias("effective_date"),
        F.lit(1).alias("ingestion_ts"))
    return hedged.read_inputs(
        [f.withColumns({"inception_date": F.to_date("inception_date"),
                        "ingestion_ts": F.lit(1)}) for f in feeds(t)],
        literal_rows(spark, RATES, "code string, bs_rate double, date date, ingestion_ts int"),
        literal_rows(spark, HIERARCHY, "lowest_level_portfolio_name string, "
                     "reporting_date_key int, tax_rate double")
        .withColumn("ingestion_ts", F.lit(1)),
        literal_rows(spark, PORTFOLIO_MAP, "program_code string, legal_id int, "
                     "security_currency string, lowest_level_portfolio_name string"),
        shocks, QUARTER)


@check(f"WITH {NET_SQL} SELECT * FROM net")
def hedged_net_exposure(t: Tables) -> DataFrame:
    return hedged.net_exposure(*hedged.net_exposure_rows(inputs(t), RULES))


@check(f"""WITH {NET_SQL}, {SHOCK_SQL},
coded AS (SELECT 'X' || CASE currency WHEN 0 THEN 'AA' WHEN 1 THEN 'BB' WHEN 2 THEN 'CC'
            WHEN 3 THEN 'DD' ELSE 'EE' END AS security_currency,
          CAST(scenario AS INTEGER) AS scenario, tenor / 12.0 AS tenor_cd, shock FROM shock),
collapsed AS (
  SELECT report_date, security_currency, asset_holding, lowest_level_portfolio_name, legal_id,
         tenor_cd, sum(sum_partial_dv01) AS dv01 FROM net GROUP BY ALL),
product AS (SELECT c.*, scenario, dv01 * shock AS p FROM collapsed c
            JOIN coded USING (security_currency, tenor_cd))
SELECT report_date, security_currency, asset_holding, lowest_level_portfolio_name, legal_id,
       scenario,
       sum(p ORDER BY tenor_cd) FILTER (asset_holding = 'Liability') * 100
         AS losses_liability,
       sum(p ORDER BY tenor_cd) FILTER (asset_holding = 'Bond') * 100 AS losses_bond,
       count(p) FILTER (asset_holding = 'Liability') AS losses_liability_tenors,
       count(p) FILTER (asset_holding = 'Bond') AS losses_bond_tenors
FROM product GROUP BY ALL""")
def hedged_class_losses(t: Tables) -> DataFrame:
    given = inputs(t)
    rows, tenors = hedged.net_exposure_rows(given, RULES)
    exposure = hedged.loss_exposure(rows, tenors, RULES)
    return hedged.class_losses(exposure, given.shocks, tenors, RULES)


@check(f"""WITH {NET_SQL}
SELECT DISTINCT 'portfolio' AS lookup, program_code || '/' || legal_id || '/' ||
  security_currency AS missing FROM net WHERE lowest_level_portfolio_name IS NULL
UNION ALL SELECT DISTINCT 'rate', strftime(report_date, '%Y-%m-%d') || '/' || security_currency
  FROM net WHERE fx_rate IS NULL
UNION ALL SELECT DISTINCT 'class', program_code FROM net WHERE asset_holding IS NULL""")
def hedged_lookup_reports(t: Tables) -> DataFrame:
    rows, _ = hedged.net_exposure_rows(inputs(t), RULES)
    rows = stage(rows, "net").df
    reports = hedged.lookup_reports(rows)
    parts = [report.where(F.col(report.columns[0]).isNotNull())
             .select(F.lit(name).alias("lookup"),
                     F.concat_ws("/", *[F.col(c).cast("string") for c in report.columns])
                     .alias("missing"))
             for name, report in reports.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@check(f"""WITH {NET_SQL},
long AS (SELECT feed.*, coalesce(price, 0) AS price FROM feed LEFT JOIN point
         USING (program_code, legal_id, security_currency, flag, tenor_cd))
SELECT 'asset' AS asset_type, DATE '2026-04-01' AS inception_date, program_code,
       CAST(legal_id AS INTEGER) AS legal_id, security_currency, lower(flag) AS source,
       CAST(tenor_cd AS DOUBLE) AS tenor_cd, CAST(price AS DOUBLE) AS dv01_value FROM long""")
def hedged_long_sensitivities(t: Tables) -> DataFrame:
    return hedged.long_sensitivities(feeds(t))


DATED_SQL = (NET_SQL
             .replace("SELECT feed.program_code,", "SELECT CASE flag WHEN 'N' THEN DATE '2025-12-31' "
                      "ELSE DATE '2026-03-31' END AS report_date, feed.program_code,")
             .replace("v(security_currency, fx)),", "v(security_currency, fx)),\n"
                      "dated AS (SELECT security_currency, DATE '2026-03-31' AS report_date, fx FROM rate "
                      "UNION ALL SELECT 'XDD', DATE '2025-12-31', 3.5),")
             .replace("DATE '2026-03-31' AS report_date, security_currency,\n", "report_date, security_currency,\n")
             .replace("LEFT JOIN rate USING (security_currency))",
                      "LEFT JOIN dated USING (security_currency, report_date))"))


@check(f"WITH {DATED_SQL} SELECT * FROM net")
def hedged_net_exposure_by_inception(t: Tables) -> DataFrame:
    """Report dates that follow from the inception dates, and rates of these dates."""
    given = inputs(t)
    first = {"n": "2026-01-01"}
    dated = [f.withColumn("inception_date", F.lit(first.get(c, "2026-04-01"))) for c, f in zip("anr", feeds(t))]
    rates = literal_rows(t.spark, RATES, "code string, bs_rate double, date date, ingestion_ts int") \
        .withColumn("date", F.date_format("date", "dd-MMM-yy"))
    return hedged.net_exposure(*hedged.net_exposure_rows(
        replace(given, feeds=dated, rates=rates), replace(RULES, quarter=None)))


@check(f"""WITH {NET_SQL}
SELECT DISTINCT lowest_level_portfolio_name FROM net
WHERE lowest_level_portfolio_name IN ('Book 2', 'Book 5') OR lowest_level_portfolio_name IS NULL""")
def portfolios_without_tax(t: Tables) -> DataFrame:
    """Portfolios that the hierarchy does not hold, and rows that have no portfolio."""
    given = inputs(t)
    less = given.hierarchy.where(~F.lower("lowest_level_portfolio_name").rlike("^book +[25]$"))
    rows, _ = hedged.net_exposure_rows(replace(given, hierarchy=less), RULES)
    return hedged.lookup_reports(stage(rows, "net").df)["tax"]
