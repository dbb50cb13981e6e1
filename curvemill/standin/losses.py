"""Check queries: exposures, scenario losses, quantiles and curve checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.amounts import base_rate, net_amount
from curvemill.functions.keys import classify, normalize_text
from curvemill.operators.curves import curve_points, missing_tenors, tail_average
from curvemill.operators.lookups import lookup
from curvemill.operators.quality import distinct_counts, incomplete_curves, unmatched_shocks
from curvemill.operators.scenarios import (
    class_curve_rows, losses_by_class, quantile_by, scenario_losses, with_quantile)
from curvemill.sources.snapshots import literal_rows
from curvemill.staging import stage
from curvemill.standin.book import (
    EXPOSURE_SQL, SHOCK_SQL, TENORS, exposure_rows, scenario_table, shock_points,
    staged_exposure, with_mask)
from curvemill.standin.registry import Tables, check

GROUP = ["segment", "currency"]
RATES = [(1, 1.25), (2, 0.5), (3, 0.75)]
TAXES = [(" Building", 0.2), ("FURNITURE", 0.28), ("house  hold", 0.1), ("Machinery ", 0.15),
         ("household", 0.25)]
CLASSES = {"Liability": ["AUTOMOBILE", "BUILDING"], "Bond": ["FURNITURE"],
           "Bank": ["HOUSEHOLD"]}
LOSS_COLUMNS = {"Liability": "loss_liability", "Bond": "loss_bond", "Bank": "loss_bank"}

LOSS_SQL = f"""
WITH {EXPOSURE_SQL}, {SHOCK_SQL},
loss AS (
  SELECT segment, currency, scenario, sum(amount * shock ORDER BY tenor) * 100 AS loss,
         count(*) AS tenor_count
  FROM exposure JOIN shock USING (currency, tenor) GROUP BY ALL)"""

NET_SQL = f"""
WITH {EXPOSURE_SQL},
rate AS (SELECT * FROM (VALUES (1, CAST(1.25 AS DOUBLE)), (2, 0.5), (3, 0.75)) v(currency, fx)),
tax AS (SELECT lower(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS name, tax_rate
        FROM (VALUES (' Building', CAST(0.2 AS DOUBLE)), ('FURNITURE', 0.28),
                     ('house  hold', 0.1), ('Machinery ', 0.15), ('household', 0.25))
             v(name, tax_rate)),
net AS (
  SELECT segment, currency, tenor, amount AS total,
         CASE WHEN currency = 0 AND fx IS NULL THEN 1.0 ELSE fx END AS fx_rate, tax_rate,
         amount * (CASE WHEN currency = 0 AND fx IS NULL THEN 1.0 ELSE fx END)
           * (1 - tax_rate) AS net,
         CASE WHEN segment IN ('AUTOMOBILE', 'BUILDING') THEN 'Liability'
              WHEN segment = 'FURNITURE' THEN 'Bond'
              WHEN segment = 'HOUSEHOLD' THEN 'Bank' END AS class
  FROM exposure LEFT JOIN rate USING (currency)
  LEFT JOIN tax ON lower(segment) = tax.name)"""


def losses(t: Tables) -> DataFrame:
    return scenario_losses(staged_exposure(t), scenario_table(t), keys=GROUP,
                           curve=["currency"], scenario="scenario", tenors=TENORS,
                           multiplier=100.0)


@check(f"{LOSS_SQL} SELECT * FROM loss")
def scenario_loss(t: Tables) -> DataFrame:
    return losses(t)


@check(f"{LOSS_SQL} SELECT * FROM loss")
def scenario_loss_shuffled(t: Tables) -> DataFrame:
    """The same when the exposure is too large to be copied."""
    return scenario_losses(staged_exposure(t), scenario_table(t), keys=GROUP,
                           curve=["currency"], scenario="scenario", tenors=TENORS,
                           multiplier=100.0, limit=0)


@check(f"""{LOSS_SQL}
SELECT segment, currency, quantile_disc(loss, 0.95) AS quantile FROM loss GROUP BY ALL""")
def scenario_quantile(t: Tables) -> DataFrame:
    return quantile_by(losses(t), GROUP, "loss", "quantile")


@check(f"""{LOSS_SQL}
SELECT l.*, q.quantile FROM loss l JOIN (
  SELECT segment, currency, quantile_disc(loss, 0.95) AS quantile FROM loss GROUP BY ALL) q
USING (segment, currency)""")
def loss_with_quantile(t: Tables) -> DataFrame:
    exposure = staged_exposure(t)
    rows = scenario_losses(exposure, scenario_table(t), keys=GROUP, curve=["currency"],
                           scenario="scenario", tenors=TENORS, multiplier=100.0)
    return with_quantile(rows, GROUP, "loss", "quantile", small=exposure.fits())


def net_rows(t: Tables) -> DataFrame:
    """Curve rows of the book with rates, class and net amounts (prefix n)."""
    rates = literal_rows(t.spark, RATES, "currency int, fx_rate double")
    taxes = literal_rows(t.spark, TAXES, "name string, tax_rate double") \
        .withColumn("name", normalize_text("name"))
    rows = with_mask(exposure_rows(t, GROUP))
    rows = lookup(rows, rates, {"currency": "currency"}, ["fx_rate"])
    rows = lookup(rows, taxes, {"name": normalize_text("segment")}, ["tax_rate"])
    rows = rows.withColumns({"fx_rate": base_rate("fx_rate", "currency", 0),
                             "class": classify("segment", CLASSES)})
    return rows.withColumns(
        {f"n{m}": net_amount(f"e{m}", "fx_rate", "tax_rate") for m in TENORS})


@check(f"""{NET_SQL}
SELECT segment, currency, fx_rate, tax_rate, class, CAST(tenor / 12 AS DOUBLE) AS tenor_years,
       total, net FROM net""")
def net_exposure(t: Tables) -> DataFrame:
    return curve_points(net_rows(t), [*GROUP, "fx_rate", "tax_rate", "class"], TENORS,
                        "emask", "tenor_years", {"e": "total", "n": "net"})


@check(f"""{NET_SQL}, {SHOCK_SQL},
point AS (SELECT currency, class, tenor, sum(net) AS net FROM net GROUP BY ALL),
product AS (SELECT currency, scenario, class, tenor, net * shock AS p
            FROM point JOIN shock USING (currency, tenor))
SELECT currency, scenario,
       sum(p ORDER BY tenor) FILTER (class = 'Liability') * 100 AS loss_liability,
       sum(p ORDER BY tenor) FILTER (class = 'Bond') * 100 AS loss_bond,
       sum(p ORDER BY tenor) FILTER (class = 'Bank') * 100 AS loss_bank,
       count(p) FILTER (class = 'Liability') AS loss_liability_tenors,
       count(p) FILTER (class = 'Bond') AS loss_bond_tenors,
       count(p) FILTER (class = 'Bank') AS loss_bank_tenors
FROM product GROUP BY ALL""")
def loss_by_class(t: Tables) -> DataFrame:
    exposure = stage(class_curve_rows(net_rows(t), ["currency"], "class",
                                      list(LOSS_COLUMNS), TENORS, "n", "emask"), "classes")
    return losses_by_class(exposure, scenario_table(t), keys=["currency"],
                           curve=["currency"], scenario="scenario", tenors=TENORS,
                           columns=LOSS_COLUMNS)


@check(f"""{NET_SQL}, {SHOCK_SQL}
SELECT segment, currency, scenario, sum(net * shock ORDER BY tenor) * 100 AS loss,
       count(net * shock) AS tenor_count
FROM net JOIN shock USING (currency, tenor) WHERE class = 'Bond' GROUP BY ALL""")
def single_class_loss(t: Tables) -> DataFrame:
    rows = net_rows(t).where(F.col("class") == "Bond")
    rows = rows.select(*GROUP, "emask", *[F.col(f"n{m}").alias(f"e{m}") for m in TENORS])
    return scenario_losses(stage(rows, "bonds"), scenario_table(t), keys=GROUP,
                           curve=["currency"], scenario="scenario", tenors=TENORS,
                           multiplier=100.0)


@check(f"""WITH {SHOCK_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY currency, scenario
                                        ORDER BY tenor DESC) AS n FROM shock)
SELECT currency, scenario, sum(shock ORDER BY tenor DESC) / count(*) AS average_shock
FROM ranked WHERE n <= 4 GROUP BY ALL""")
def average_tail_shock(t: Tables) -> DataFrame:
    return scenario_table(t).select("currency", "scenario",
                                    tail_average(TENORS, "s", 4).alias("average_shock"))


GAPS_SQL = f"""WITH {EXPOSURE_SQL}, {SHOCK_SQL}
SELECT currency, string_agg(CAST(tenor AS VARCHAR), ',' ORDER BY tenor) AS tenors
FROM (SELECT DISTINCT currency, tenor FROM exposure
      EXCEPT SELECT currency, tenor FROM shock WHERE tenor <> 36 AND NOT
             (currency = 2 AND tenor = 60)) GROUP BY currency"""


def shocks_with_gaps(t: Tables) -> DataFrame:
    return shock_points(t).where("tenor <> 36 and not (currency = 2 and tenor = 60)")


@check(GAPS_SQL, "unmatched_shocks")
def gaps_of_long_curves(t: Tables) -> DataFrame:
    exposure = curve_points(with_mask(exposure_rows(t, GROUP)), GROUP, TENORS, "emask",
                            "years", {"e": "amount"})
    exposure = exposure.select("currency", (F.col("years") * 12).cast("int").alias("tenor"))
    report = unmatched_shocks(exposure, shocks_with_gaps(t), ["currency"], "tenor")
    return report.select("currency", F.array_join("tenors", ",").alias("tenors"))


@check(GAPS_SQL)
def unmatched_shocks_of_curve_rows(t: Tables) -> DataFrame:
    report = missing_tenors(with_mask(exposure_rows(t, GROUP)),
                            scenario_table(t, shocks_with_gaps(t)), ["currency"], TENORS)
    return report.select("currency", F.array_join(F.transform(
        "tenors", lambda m: m.cast("string")), ",").alias("tenors"))


@check(f"""WITH {EXPOSURE_SQL}, {SHOCK_SQL}
SELECT segment, currency, scenario, sum(amount * shock ORDER BY tenor) AS loss,
       count(*) AS tenor_count
FROM exposure JOIN shock USING (currency, tenor)
WHERE NOT (currency = 2 AND tenor = 60) GROUP BY ALL HAVING count(*) NOT IN (0, 5)""")
def curve_completeness(t: Tables) -> DataFrame:
    shocks = shock_points(t).where("not (currency = 2 and tenor = 60)")
    rows = scenario_losses(staged_exposure(t), scenario_table(t, shocks), keys=GROUP,
                           curve=["currency"], scenario="scenario", tenors=TENORS)
    return incomplete_curves(rows, ["tenor_count"], len(TENORS))


@check(f"""WITH {SHOCK_SQL}
SELECT currency, count(DISTINCT scenario) AS scenarios, count(DISTINCT tenor) AS tenors
FROM shock GROUP BY currency""")
def scenario_counts(t: Tables) -> DataFrame:
    return distinct_counts(shock_points(t), ["currency"],
                           {"scenarios": "scenario", "tenors": "tenor"})


@check("""
SELECT l_returnflag, quantile_disc(l_extendedprice, 0.95) AS quantile FROM lineitem
GROUP BY l_returnflag""")
def price_quantile(t: Tables) -> DataFrame:
    return quantile_by(t.lineitem, ["l_returnflag"], "l_extendedprice", "quantile")
