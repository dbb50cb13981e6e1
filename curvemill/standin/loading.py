"""Check queries: loads, pulls with an offset log, rejected rows, file order, history, sketches."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.operators.shaping import tagged_union
from curvemill.operators.sketches import quantile_of_loads, read_sketches, store_sketches
from curvemill.sources import loads
from curvemill.sources.feeds import read_delimited
from curvemill.sources.file_order import fill_in_file_order
from curvemill.sources.history import refresh_by_difference, state_of
from curvemill.sources.pulls import pull_new_files
from curvemill.sources.rejects import Checked, read_checked
from curvemill.staging import shared_folder
from curvemill.standin.registry import Tables, check

# Orders come in as four loads; a quarter of the orders are in each.
LOADS = [f"load{i}" for i in range(4)]


def folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def order_loads(t: Tables, target: str, names: list[str] = LOADS) -> None:
    for name in names:
        part = t.orders.where(F.col("o_orderkey") % len(LOADS) == LOADS.index(name))
        loads.write_load(part, target, name, "o_orderdate", ["o_orderstatus"])


@check("""
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderdate =
  (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')""")
def newest_load_by_manifest(t: Tables) -> DataFrame:
    target = folder(t, "order-loads")
    order_loads(t, target)
    return loads.read_newest(t.spark, target, "o_orderstatus = 'F'", "o_orderdate").drop(loads.LOAD)


@check("""
SELECT *, 'load' || CAST(o_orderkey % 4 AS VARCHAR) AS load_id FROM orders
WHERE o_orderkey % 4 <> 2""")
def repeated_loads(t: Tables) -> DataFrame:
    """Each load is written, two of them again, and one again without rows."""
    target = folder(t, "repeated-loads")
    order_loads(t, target)
    order_loads(t, target, LOADS[1:3])
    loads.write_load(t.orders.where("false"), target, LOADS[2], "o_orderdate", ["o_orderstatus"])
    return loads.read_loads(t.spark, target)


@check("SELECT *, event_id % 10 = 0 AS is_late FROM events")
def offset_pull(t: Tables) -> DataFrame:
    """Rows that arrive after a pull under stamps that are already on file come once as well."""
    source, target, log = (folder(t, n) for n in ("source", "pulled", "offsets"))
    rows = t.events.withColumn("is_late", F.col("event_id") % 10 == 0)
    for arrived in (rows.where("not is_late and event_id % 2 = 0"),
                    rows.where("not is_late and event_id % 2 = 1"), rows.where("is_late")):
        arrived.write.mode("append").parquet(source)
        pull_new_files(t.spark, source, target, log)
    pull_new_files(t.spark, source, target, log)
    return t.spark.read.parquet(target)


@check("""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 NOT IN (3, 5, 7)""")
def checked_good_rows(t: Tables) -> DataFrame:
    return checked_customers(t).good


@check("""
SELECT CASE c_custkey % 10
         WHEN 3 THEN c_custkey || ',' || c_name || ',n/a,' || c_mktsegment
         WHEN 5 THEN 'no ' || c_custkey || ',' || c_name || ',' || c_acctbal || ',' || c_mktsegment
         ELSE c_custkey || ',' || c_name END AS record,
       CASE c_custkey % 10 WHEN 3 THEN 'c_acctbal' WHEN 5 THEN 'c_custkey' END AS "column",
       CASE c_custkey % 10 WHEN 3 THEN 'n/a' WHEN 5 THEN 'no ' || c_custkey
         ELSE c_custkey || ',' || c_name END AS value,
       CASE c_custkey % 10 WHEN 3 THEN 'not a double' WHEN 5 THEN 'not a bigint'
         ELSE 'the record has another number of columns' END AS reason
FROM customer WHERE c_custkey % 10 IN (3, 5, 7)""")
def rejected_rows(t: Tables) -> DataFrame:
    rejected = checked_customers(t).rejected.where("file is not null")
    return rejected.select("record", F.explode("problems").alias("p")).select("record", "p.*")


def checked_customers(t: Tables) -> Checked:
    """Customers as delimited lines, three in ten of them damaged, read back."""
    source = folder(t, "damaged")
    digit, key = F.col("c_custkey") % 10, F.col("c_custkey").cast("string")
    balance = F.when(digit == 3, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    key = F.when(digit == 5, F.concat(F.lit("no "), key)).otherwise(key)
    line = F.when(digit == 7, F.concat_ws(",", key, "c_name")).otherwise(
        F.concat_ws(",", key, "c_name", balance, "c_mktsegment"))
    t.customer.select(line.alias("value")).write.text(source)
    return read_checked(t.spark, source, "c_custkey bigint, c_name string, c_acctbal double, "
                        "c_mktsegment string", header=False)


@check("""
SELECT o_orderkey, o_totalprice, last_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus END
                                            IGNORE NULLS) OVER (ORDER BY o_orderkey) AS o_orderstatus
FROM orders""")
def fill_of_files(t: Tables) -> DataFrame:
    """An extract of several files in which a value stands for the rows below it as well."""
    source = folder(t, "extract")
    given = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderstatus"))
    rows = t.orders.select("o_orderkey", "o_totalprice", given.alias("o_orderstatus"))
    rows.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey") \
        .write.option("header", True).csv(source)
    read = read_delimited(t.spark, source, "o_orderkey bigint, o_totalprice double, o_orderstatus string")
    return fill_in_file_order(read, ["o_orderstatus"], piece=5000)


def customer_states(t: Tables) -> dict[date, DataFrame]:
    """Three states of a dimension: keys come and go, and some rows change."""
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    more = F.col("c_acctbal") + F.when(F.col("c_custkey") % 3 == 0, 1.0).otherwise(0.0)
    return {date(2026, 1, 1): rows.where("c_custkey % 10 <> 0"),
            date(2026, 2, 1): rows.where("c_custkey % 7 <> 0").withColumn("c_acctbal", more),
            date(2026, 3, 1): rows}


@check("""
WITH one AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 10 <> 0),
two AS (SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1.0 ELSE 0.0 END AS c_acctbal
        FROM customer WHERE c_custkey % 7 <> 0),
three AS (SELECT c_custkey, c_name, c_acctbal FROM customer)
SELECT '2026-01-01' AS day, * FROM one UNION ALL SELECT '2026-01-31', * FROM one
UNION ALL SELECT '2026-02-01', * FROM two UNION ALL SELECT '2026-02-28', * FROM two
UNION ALL SELECT 'now', * FROM three""")
def dimension_by_difference(t: Tables) -> DataFrame:
    target = folder(t, "history")
    for since, state in customer_states(t).items():
        refresh_by_difference(t.spark, state, target, ["c_custkey"], since, f"from-{since}")
    days = [date(2025, 12, 31), date(2026, 1, 1), date(2026, 1, 31), date(2026, 2, 1), date(2026, 2, 28)]
    states = {str(d): state_of(t.spark, target, ["c_custkey"], d) for d in days}
    return tagged_union({**states, "now": state_of(t.spark, target, ["c_custkey"])}, "day")


@check("""
SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.95) AS quantile FROM lineitem
GROUP BY ALL""")
def quantile_of_sketches(t: Tables) -> DataFrame:
    """Three loads leave sketches; the quantile over all of them reads these and one bracket."""
    target, keys = folder(t, "sketches"), ["l_returnflag", "l_linestatus"]
    for i in range(3):
        load = t.lineitem.where(F.col("l_orderkey") % 3 == i)
        store_sketches(load, target, f"load{i}", keys, "l_extendedprice")
    return quantile_of_loads(t.lineitem, read_sketches(t.spark, target), keys, "l_extendedprice",
                             "quantile")
