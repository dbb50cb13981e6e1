"""Check queries: curves of 120 tenors and three classes against scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.operators.dense import dense_losses, dense_rows
from curvemill.staging import BROADCAST_ROWS, stage
from curvemill.standin.registry import Tables, check

MONTHS = list(range(1, 121))
CLASSES = {"loss_a": "A", "loss_n": "N", "loss_r": "R"}

DENSE_SQL = """
WITH line AS (
  SELECT c_mktsegment AS segment, CAST(n_regionkey AS INTEGER) AS currency, l_returnflag AS class,
         1 + datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 120 AS tenor,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
exposure AS (SELECT segment, currency, class, tenor, CAST(sum(price) AS DOUBLE) AS amount
             FROM line GROUP BY ALL),
shock AS (SELECT CAST(l_suppkey % 5 AS INTEGER) AS currency, l_suppkey AS scenario,
                 1 + l_partkey % 120 AS tenor, max(l_discount - l_tax) AS shock
          FROM lineitem GROUP BY ALL),
product AS (SELECT segment, currency, class, scenario, tenor, amount * shock AS p
            FROM exposure JOIN shock USING (currency, tenor))"""


def ship_tenor(day: str) -> Column:
    return (F.datediff(F.col(day).cast("date"), F.lit("1992-01-01").cast("date")) % 120 + 1).cast("int")


def dense_exposure(t: Tables) -> DataFrame:
    """Cents per order and month first, so that orders and customers join reduced rows."""
    lines = t.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("class"),
                               ship_tenor("l_shipdate").alias("tenor")).agg(
        F.sum("l_extendedprice").alias("price"))
    book = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return lines.join(book, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_mktsegment").alias("segment"), F.col("n_regionkey").alias("currency"), "class",
        "tenor", "price")


def dense_scenarios(t: Tables) -> DataFrame:
    points = t.lineitem.select((F.col("l_suppkey") % 5).cast("int").alias("currency"),
                               F.col("l_suppkey").alias("scenario"),
                               (F.col("l_partkey") % 120 + 1).cast("int").alias("tenor"),
                               (F.col("l_discount") - F.col("l_tax")).alias("shock"))
    return dense_rows(points, ["currency", "scenario"], "tenor", "shock", MONTHS, "s", combine="max",
                      strict=False)


def dense_by_class(t: Tables, limit: int = BROADCAST_ROWS) -> DataFrame:
    rows = dense_rows(dense_exposure(t), ["segment", "currency"], "tenor", "price", MONTHS, "e", scale=2,
                      classes=("class", list(CLASSES.values())))
    return dense_losses(stage(rows, "dense"), dense_scenarios(t), keys=["segment", "currency"],
                        curve=["currency"], scenario="scenario", tenors=len(MONTHS),
                        losses={n: f"e{i}" for i, n in enumerate(CLASSES)}, multiplier=100.0, limit=limit)


CLASS_SQL = DENSE_SQL + """
SELECT segment, currency, scenario,
       sum(p ORDER BY tenor) FILTER (class = 'A') * 100 AS loss_a,
       sum(p ORDER BY tenor) FILTER (class = 'N') * 100 AS loss_n,
       sum(p ORDER BY tenor) FILTER (class = 'R') * 100 AS loss_r,
       count(p) FILTER (class = 'A') AS loss_a_tenors, count(p) FILTER (class = 'N') AS loss_n_tenors,
       count(p) FILTER (class = 'R') AS loss_r_tenors
FROM product GROUP BY ALL"""


@check(CLASS_SQL)
def dense_loss_by_class(t: Tables) -> DataFrame:
    return dense_by_class(t)


@check(CLASS_SQL)
def dense_loss_by_class_shuffled(t: Tables) -> DataFrame:
    """The same with no side small enough to be copied."""
    return dense_by_class(t, limit=0)


@check(DENSE_SQL + """,
total AS (SELECT segment, currency, tenor, CAST(sum(price) AS DOUBLE) AS amount FROM line GROUP BY ALL)
SELECT segment, currency, scenario, sum(amount * shock ORDER BY tenor) / 10 AS loss,
       count(*) AS loss_tenors
FROM total JOIN shock USING (currency, tenor) GROUP BY ALL""")
def dense_scenario_loss(t: Tables) -> DataFrame:
    rows = dense_rows(dense_exposure(t), ["segment", "currency"], "tenor", "price", MONTHS, "e", scale=2)
    return dense_losses(stage(rows, "dense"), dense_scenarios(t), keys=["segment", "currency"],
                        curve=["currency"], scenario="scenario", tenors=len(MONTHS),
                        losses={"loss": "e"}, divisor=10.0)
