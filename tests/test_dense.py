"""Dense curves: layout, losses by hand, plan in generated code, shuffled and copied sides."""

import re

import pytest
from pyspark.sql import functions as F

from curvemill.operators.dense import WIDTH, dense_losses, dense_rows
from curvemill.staging import stage

MONTHS = list(range(1, 121))


def points(spark, n=400):
    return spark.range(n).selectExpr(
        "id % 3 as book", "id % 2 as currency", "case id % 4 when 0 then 'A' when 1 then 'B' "
        "when 2 then 'C' end as class", "int(1 + id * 7 % 120) as tenor",
        "if(id % 11 = 0, null, id / 4) as amount")


def test_layout_of_a_dense_row(rows):
    tenors = [3 * (i + 1) for i in range(130)]
    df = rows([("k", 3, 1.0), ("k", 3, 2.5), ("k", 390, 4.0), ("k", 6, None), ("l", None, 9.0)],
              "key string, tenor int, v double")
    found = {r.key: r for r in dense_rows(df, ["key"], "tenor", "v", tenors, "e").collect()}
    assert set(found) == {"k"}
    assert len(found["k"].e) == 130 and found["k"].e[0] == 3.5 and found["k"].e[129] == 4.0
    assert [i for i, v in enumerate(found["k"].e) if v is not None] == [0, 129]
    assert list(found["k"].emask) == [1, 0, 1 << 129 % WIDTH]


def test_undeclared_tenors_fail_or_are_left_out(rows):
    df = rows([("k", 5, 1.0), ("k", 12, 1.0)], "key string, tenor int, v double")
    assert dense_rows(df, ["key"], "tenor", "v", [12], "e", strict=False).first().e == [1.0]
    with pytest.raises(Exception, match="tenor is not declared: 5"):
        dense_rows(df, ["key"], "tenor", "v", [12], "e").collect()


@pytest.mark.parametrize("limit", [0, 100_000])
def test_losses_by_hand(spark, limit):
    exposure = dense_rows(points(spark), ["book", "currency"], "tenor", "amount", MONTHS, "e",
                          classes=("class", ["A", "B", "Z"]))
    shocks = spark.range(900).selectExpr("id % 2 as currency", "id % 5 as scenario",
                                         "int(1 + id % 60 * 2) as tenor", "id / 8 as shock")
    dense = dense_rows(shocks, ["currency", "scenario"], "tenor", "shock", MONTHS, "s", "max", strict=False)
    got = dense_losses(stage(exposure, "d"), dense, keys=["book", "currency"], curve=["currency"],
                       scenario="scenario", tenors=120, losses={"a": "e0", "b": "e1", "z": "e2"},
                       multiplier=100.0, limit=limit)
    amounts, best = {}, {}
    for r in points(spark).collect():
        if r.amount is not None:
            key = r.book, r.currency, r["class"], r.tenor
            amounts[key] = amounts.get(key, 0.0) + r.amount
    for r in shocks.collect():
        key = r.currency, r.scenario, r.tenor
        best[key] = max(best.get(key, r.shock), r.shock)
    want = {}
    for (book, currency, name, tenor), amount in sorted(amounts.items(), key=repr):
        for scenario in range(5):
            shock = best.get((currency, scenario, tenor))
            if shock is not None and name in ("A", "B"):
                want.setdefault((book, currency, scenario), {}).setdefault(name, {})[tenor] = amount * shock
    found = {(r.book, r.currency, r.scenario): r for r in got.collect()}
    assert set(found) == set(want) and want
    for key, by_class in want.items():
        for name, column in (("A", "a"), ("B", "b")):
            terms = by_class.get(name, {})
            total = 0.0
            for tenor in sorted(terms):
                total += terms[tenor]
            assert found[key][f"{column}_tenors"] == len(terms)
            assert found[key][column] == (total * 100.0 / 1.0 if terms else None)
        assert found[key].z is None and found[key].z_tenors == 0


def test_120_tenors_and_three_classes_are_one_generated_stage(spark):
    exposure = stage(dense_rows(points(spark), ["book", "currency"], "tenor", "amount", MONTHS, "e",
                                classes=("class", ["A", "B", "C"])), "d")
    shocks = stage(dense_rows(points(spark), ["currency", "book"], "tenor", "amount", MONTHS, "s")
                   .withColumnRenamed("book", "scenario"), "s").df
    losses = dense_losses(exposure, shocks, keys=["book", "currency"], curve=["currency"],
                          scenario="scenario", tenors=120, losses={c: f"e{i}" for i, c in enumerate("abc")})
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = losses.withColumn("more", F.lit(1))._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
        shown = plan.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) == 2 and max(sizes) < 8000      # the JVM compiles methods up to 8000 bytes
    lines = [x.strip(" +-:") for x in shown.split("\n") if "Project" in x or "Join" in x]
    assert len(lines) > 15 and all(re.match(r"\*\(\d+\)", x) for x in lines)
    assert len({re.match(r"\*\((\d+)\)", x)[1] for x in lines}) == 1
