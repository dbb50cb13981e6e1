import random

import pytest
from pyspark.sql import functions as F

from curvemill.operators import curves, scenarios
from curvemill.staging import Staged, join_small, stage
from tests.conftest import as_tuples

TENORS = [3, 6, 12]


def test_unpivot_keeps_nulls_and_uses_years(rows):
    df = rows([("k", 10.0, None, 2.0, "x")],
              "key string, `003M` double, `006M` double, `001M` double, other string")
    assert as_tuples(curves.unpivot_curve(df, ["key"])) == sorted(
        [("k", 0.25, 10.0), ("k", 0.5, None), ("k", 1 / 12, 2.0)], key=repr)
    with pytest.raises(ValueError, match="No tenor columns"):
        curves.unpivot_curve(df.select("key"), ["key"])


def test_tenor_months_absorbs_float_noise(rows):
    df = rows([(1 / 12,), (0.25000000001,), (30.0,)], "y double")
    assert [r[0] for r in df.select(curves.tenor_months("y")).collect()] == [1, 3, 360]


def test_wide_rows_equal_long_totals(rows):
    a = rows([("k", 1.5, None), ("k", 2.25, 4.0), ("j", 1.0, 1.0)],
             "key string, `003M` double, `006M` double")
    b = rows([("k", 7.0)], "key string, `012M` double")
    wide = curves.zero_tenors(a).unionByName(curves.zero_tenors(b), allowMissingColumns=True)
    found, tenors = curves.wide_curve_rows(wide, ["key"], "e", 2)
    assert tenors == TENORS
    assert as_tuples(curves.curve_points(found, ["key"], tenors, "emask", "t", {"e": "v"})) \
        == [("j", 0.25, 1.0), ("j", 0.5, 1.0), ("k", 0.25, 3.75), ("k", 0.5, 4.0),
            ("k", 1.0, 7.0)]


def test_undeclared_tenor_fails_on_the_strict_side(rows):
    df = rows([("k", 3, 1.0), ("k", 24, 1.0)], "key string, t int, v double")
    with pytest.raises(Exception, match="tenor is not declared: 24"):
        curves.curve_rows(df, ["key"], "t", "v", TENORS, "e").collect()
    kept = curves.curve_rows(df, ["key"], "t", "v", TENORS, "s", strict=False)
    assert as_tuples(kept) == [("k", 1.0, None, None, 1)]
    with pytest.raises(ValueError):
        curves.curve_rows(df, ["key"], "t", "v", [], "e")


@pytest.mark.parametrize("n", [63, 64, 130])
def test_curves_of_any_number_of_tenors(rows, n):
    tenors = list(range(1, n + 1))
    e = rows([("p", "A", t, float(t)) for t in tenors[1:]] + [("q", "A", n, 1.0)],
             "portfolio string, currency string, tenor int, amount double")
    s = rows([("A", 7, t, 2.0) for t in tenors[:-1]],
             "currency string, scenario int, tenor int, shock double")
    keys = ["portfolio", "currency"]
    book = curves.curve_rows(e, keys, "tenor", "amount", tenors, "e")
    table = scenarios.shock_rows(s, ["currency"], "scenario", "tenor", "shock", tenors)
    back = curves.curve_points(book, keys, tenors, "emask", "years", {"e": "amount"})
    assert as_tuples(back.select("portfolio", curves.tenor_months("years"), "amount")) == \
        as_tuples(e.select("portfolio", "tenor", "amount"))
    losses = scenarios.scenario_losses(stage(book, "many"), table, keys=keys, curve=["currency"],
                                       scenario="scenario", tenors=tenors)
    assert as_tuples(losses) == [("p", "A", 7, float(2 * sum(tenors[1:-1])), n - 2)]
    assert as_tuples(curves.missing_tenors(book, table, ["currency"], tenors)) == [("A", [n])]
    blocks = scenarios.class_curve_rows(book.withColumn("class", F.lit("x")), ["currency"],
                                        "class", ["x"], tenors, "e", "emask")
    whole = scenarios.losses_by_class(stage(blocks, "blocks"), table, keys=["currency"],
                                      curve=["currency"], scenario="scenario", tenors=tenors,
                                      columns={"x": "loss"}, multiplier=1.0)
    assert as_tuples(whole) == [("A", 7, float(2 * sum(tenors[1:-1])), n - 2)]
    wide = book.select("portfolio", *[F.col(f"e{m}").alias(f"{m:03d}M") for m in tenors])
    summed, found = curves.wide_curve_rows(wide, ["portfolio"], "e")
    assert found == tenors and as_tuples(summed.select("portfolio", *curves.mask_columns(
        summed, "emask"))) == as_tuples(book.select("portfolio", *curves.mask_columns(book, "emask")))


def test_tail_average(rows):
    df = rows([(1.0, 2.0, 6.0), (None, 2.0, None), (None, None, None)],
              "s3 double, s6 double, s12 double")
    assert [r[0] for r in df.select(curves.tail_average(TENORS, "s", 2)).collect()] \
        == [4.0, 2.0, None]


def long_losses(exposure, shocks, multiplier):
    """The definition: match point by point, then sum per key and scenario."""
    best = {}
    for cur, scenario, t, s in shocks:
        key = (cur, scenario, t)
        best[key] = s if best.get(key) is None else max(x for x in (best[key], s)
                                                         if x is not None)
    out = {}
    for key, cur, t, e in exposure:
        for (c, scenario, u), s in best.items():
            if (cur, t) == (c, u):
                sums = out.setdefault((key, cur, scenario), [])
                if e is not None and s is not None:
                    sums.append((t, e * s))
    return sorted(((*k, sum(p for _, p in sorted(v)) * multiplier if v else None, len(v))
                   for k, v in out.items()), key=repr)


def random_book(seed):
    r = random.Random(seed)
    exposure = [(f"p{p}", c, t, r.choice([None, float(r.randint(-9, 9))]) if p == 2
                 else float(r.randint(-9, 9)))
                for p in range(5) for c in "abc" for t in TENORS if r.random() < 0.8]
    shocks = [(c, s, t, float(r.randint(-5, 5)))
              for c in "abd" for s in range(20) for t in [*TENORS, 60] if r.random() < 0.8]
    return exposure, shocks + r.sample(shocks, 10)


@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_losses_equal_definition_on_both_join_paths(rows, limit, seed):
    exposure, shocks = random_book(seed)
    e = rows(exposure, "portfolio string, currency string, tenor int, amount double")
    s = rows(shocks, "currency string, scenario int, tenor int, shock double")
    book = stage(curves.curve_rows(e, ["portfolio", "currency"], "tenor", "amount", TENORS, "e"), "book")
    table = scenarios.shock_rows(s, ["currency"], "scenario", "tenor", "shock", TENORS)
    found = scenarios.scenario_losses(
        book, table, keys=["portfolio", "currency"], curve=["currency"],
        scenario="scenario", tenors=TENORS, multiplier=100.0, limit=limit)
    assert as_tuples(found) == long_losses(exposure, shocks, 100.0)


def test_grid_join_meets_every_pair_once(spark, rows):
    large = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("s"))
    small = rows([(i % 2, i) for i in range(40)], "k long, p int")
    pairs = join_small(large, Staged(small, 40, 640), ["k"], limit=10)
    assert "BroadcastExchange" not in pairs._jdf.queryExecution().sparkPlan().toString()
    assert pairs.count() == pairs.distinct().count() == 2 * 150 * 20


def one_book(rows, shocks):
    e = rows([("p", "A", 3, 1.0), ("p", "A", 6, 2.0), ("p", "A", 12, 3.0)],
             "portfolio string, currency string, tenor int, amount double")
    s = rows(shocks, "currency string, scenario int, tenor int, shock double")
    book = stage(curves.curve_rows(e, ["portfolio", "currency"], "tenor", "amount", TENORS, "e"), "book")
    table = scenarios.shock_rows(s, ["currency"], "scenario", "tenor", "shock", TENORS)
    return as_tuples(scenarios.scenario_losses(
        book, table, keys=["portfolio"], curve=["currency"], scenario="scenario",
        tenors=TENORS, multiplier=100.0))


def test_hand_made_losses(rows):
    full = [("A", 1, 3, 10.0), ("A", 1, 6, 20.0), ("A", 1, 12, 30.0)]
    assert one_book(rows, full) == [("p", 1, 14000.0, 3)]
    assert one_book(rows, full[:2]) == [("p", 1, 5000.0, 2)]
    assert one_book(rows, [("A", 1, t, 0.0) for t in TENORS]) == [("p", 1, 0.0, 3)]
    assert one_book(rows, [("B", 1, 3, 1.0)]) == []


def test_losses_by_class_add_up_and_empty_class_is_null(rows):
    e = rows([("x", "A", "Bond", 3, 1.0), ("x", "A", "Bank", 3, 2.0), ("x", "A", None, 3, 9.0),
              ("y", "A", None, 6, 1.0)],
             "key string, currency string, class string, tenor int, amount double")
    fine = curves.curve_rows(e, ["key", "currency", "class"], "tenor", "amount", TENORS, "e")
    blocks = scenarios.class_curve_rows(fine, ["key", "currency"], "class",
                                        ["Bond", "Bank", "Liability"], TENORS, "e", "emask")
    s = rows([("A", 7, 3, 10.0), ("A", 7, 6, 1.0)],
             "currency string, scenario int, tenor int, shock double")
    table = scenarios.shock_rows(s, ["currency"], "scenario", "tenor", "shock", TENORS)
    found = scenarios.losses_by_class(
        stage(blocks, "blocks"), table, keys=["key"], curve=["currency"],
        scenario="scenario", tenors=TENORS,
        columns={"Bond": "bond", "Bank": "bank", "Liability": "liability"})
    assert as_tuples(found) == [("x", 7, 1000.0, 2000.0, None, 1, 1, 0),
                                ("y", 7, None, None, None, 0, 0, 0)]


def test_quantile_takes_a_value_of_the_group(rows):
    df = rows([("g", float(i)) for i in range(1, 21)] + [(None, 5.0)], "g string, v double")
    assert as_tuples(scenarios.quantile_by(df.where("g is not null"), ["g"], "v", "q")) \
        == [("g", 19.0)]
    rated = scenarios.with_quantile(df, ["g"], "v", "q")
    assert rated.count() == 20 and {r["q"] for r in rated.collect()} == {19.0}


def test_quantile_of_5000_scenarios_is_exact(spark):
    df = spark.range(5000).repartition(8).select(F.lit("g").alias("g"),
                                                 F.col("id").cast("double").alias("v"))
    assert scenarios.quantile_by(df, ["g"], "v", "q").first()["q"] == 4749.0


def test_gamma_and_second_order(rows):
    df = rows([("k", "up", 3.0), ("k", "down", -1.0), ("k", "other", 9.0), ("j", "up", 3.0)],
              "key string, shift string, v double")
    gamma = scenarios.parallel_gamma(df, ["key"], "shift", "v", "up", "down")
    assert as_tuples(gamma) == [("j", 3.0, None, None), ("k", 3.0, -1.0, 8.0)]
    shock = rows([(8.0, 0.5)], "gamma double, shock double")
    assert shock.select(scenarios.second_order("gamma", "shock")).first()[0] == 1.0


def test_total_needs_both_orders(rows):
    first = rows([("a", 1, 1.0), ("a", 2, 2.0)], "k string, s int, amount double")
    second = rows([("A", 1, 10.0), ("b", 1, 10.0)], "k string, s int, amount double")
    plain = scenarios.total_losses(first, second, ["k"], "s")
    loose = scenarios.total_losses(first, second, ["k"], "s", normalized={"k": F.lower("k")})
    assert as_tuples(plain) == [] and as_tuples(loose) == [("a", 1, 11.0)]


def test_invariants(rows):
    exposure, shocks = random_book(3)
    s = rows(shocks, "currency string, scenario int, tenor int, shock double")
    table = scenarios.shock_rows(s, ["currency"], "scenario", "tenor", "shock", TENORS)

    def losses(points):
        e = rows([(p, "odd" if int(p[1]) % 2 else "even", c, t, a) for p, c, t, a in points],
                 "portfolio string, class string, currency string, tenor int, amount double")
        fine = curves.curve_rows(e, ["currency", "class"], "tenor", "amount", TENORS, "e")
        blocks = scenarios.class_curve_rows(fine, ["currency"], "class", ["odd", "even"],
                                            TENORS, "e", "emask")
        whole = curves.curve_rows(e, ["currency"], "tenor", "amount", TENORS, "e")
        given = dict(keys=["currency"], curve=["currency"], scenario="scenario", tenors=TENORS)
        split = scenarios.losses_by_class(stage(blocks, "b"), table, multiplier=1.0,
                                          columns={"odd": "o", "even": "e"}, **given)
        total = scenarios.scenario_losses(stage(whole, "w"), table, **given)
        return ({(r["currency"], r["scenario"]): (r["o"] or 0.0) + (r["e"] or 0.0)
                 for r in split.collect()},
                {(r["currency"], r["scenario"]): r["loss"] for r in total.collect()})

    known = [r for r in exposure if r[3] is not None]
    split, total = losses(known)
    assert split == total and len(total) > 20
    tripled = losses([(*r[:3], 3 * r[3]) for r in known])[1]
    assert tripled == {k: 3 * v for k, v in total.items()}


def test_quantile_of_a_large_group_is_exact(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "a").alias("g"), (F.col("id") * 7919 % 100_003 / 7).alias("v"))
    got = {r.g: r.q for r in scenarios.quantile_by(rows, ["g"], "v", "q").collect()}
    for g in ("a", None):
        v = sorted(r.v for r in rows.where(F.col("g").eqNullSafe(F.lit(g))).collect())
        assert got[g] == v[-(-95 * len(v) // 100) - 1]
