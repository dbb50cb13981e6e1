"""Rejected rows, order in files, history by difference, quantiles from sketches."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from curvemill.operators import scenarios, sketches
from curvemill.sources.file_order import file_positions, fill_in_file_order
from curvemill.sources.history import refresh_by_difference, state_of
from curvemill.sources.loads import read_loads
from curvemill.sources.rejects import checked_types, read_checked
from tests.conftest import as_tuples

SCHEMA = "code string, rate double, day date"


def test_every_record_is_good_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("DAY,CODE,RATE\n2026-03-31,USD,1.5\n31/03/2026,EUR,x\n,,\n2026-01-01,GBP\n")
    (tmp_path / "b.csv").write_text("day,code,rate\n2026-02-30,CHF,2\n2026-02-01,\"a,b\",3,4\n2026-02-02,\"a,b\",7\n")
    checked = read_checked(spark, str(tmp_path), SCHEMA)
    assert checked.good.columns == ["code", "rate", "day"]
    assert as_tuples(checked.good) == sorted([("USD", 1.5, date(2026, 3, 31)), ("a,b", 7.0, date(2026, 2, 2)),
                                              (None, None, None)], key=repr)
    rejected = {r.record: r for r in checked.rejected.collect()}
    assert set(rejected) == {"31/03/2026,EUR,x", "2026-01-01,GBP", "2026-02-30,CHF,2", '2026-02-01,"a,b",3,4'}
    assert {(p["column"], p["value"], p["reason"]) for p in rejected["31/03/2026,EUR,x"].problems} == {
        ("day", "31/03/2026", "not a date"), ("rate", "x", "not a double")}
    assert rejected["2026-01-01,GBP"].problems[0]["reason"] == "the record has another number of columns"
    assert rejected["2026-01-01,GBP"].file.endswith("a.csv") and rejected["2026-02-30,CHF,2"].file.endswith("b.csv")


def test_checked_headers_and_types(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="The header has"):
        read_checked(spark, str(tmp_path), "a int, b int")
    assert as_tuples(read_checked(spark, str(tmp_path), "a int, b int", positional=True).good) == [(1, 2)]
    df = checked_types(rows([("1", "x"), (None, "2")], "a string, b string"), {"a": "int", "b": "int"})
    got = df.select("a", "b", F.transform("problems", lambda p: p["column"]).alias("p")).collect()
    assert {(r.a, r.b, tuple(r.p)) for r in got} == {(1, None, ("b",)), (None, 2, ())}


def test_fill_in_file_order_over_many_splits(spark, tmp_path):
    rng, lines, want, last = random.Random(3), [], [], None
    for f in range(5):
        lines = []
        for i in range(700):
            value = f"v{f}-{i}" if rng.random() < 0.02 else ""
            last = value or last
            lines.append(f"{f * 1000 + i},{value}")
            want.append((f * 1000 + i, last))
        (tmp_path / f"part-{f}.csv").write_text("\n".join(lines) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        df = spark.read.schema("id int, v string").csv(str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        assert as_tuples(fill_in_file_order(df, ["v"], piece=130)) == sorted(want, key=repr)
        placed = file_positions(df).orderBy("position").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [(r.position, r.id) for r in placed] == list(enumerate(w[0] for w in want))


def test_history_by_difference(spark, rows, tmp_path):
    target, keys = str(tmp_path / "h"), ["k"]
    state = lambda *data: rows(list(data), "k int, v string, w double")
    one, two, three = date(2026, 1, 1), date(2026, 1, 5), date(2026, 2, 1)
    first = state((1, "a", 1.0), (2, None, 2.0), (3, "c", None))
    second = state((1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0))
    assert refresh_by_difference(spark, first, target, keys, one, "l1") == 3
    assert refresh_by_difference(spark, second, target, keys, two, "l2") == 3
    assert refresh_by_difference(spark, second, target, keys, two, "l2") == 3      # repeated
    assert refresh_by_difference(spark, second, target, keys, three, "l3") == 0
    assert refresh_by_difference(spark, first, target, keys, three, "l3") == 3
    changes = read_loads(spark, target).where("load_id = 'l2'").select("k", "change")
    assert as_tuples(changes) == [(2, "changed"), (3, "ended"), (4, "new")]
    for day, want in ((date(2025, 12, 31), []), (one, first), (date(2026, 1, 4), first), (two, second),
                      (date(2026, 1, 31), second), (three, first), (None, first)):
        got = state_of(spark, target, keys, day)
        assert got.columns == ["k", "v", "w"]
        assert as_tuples(got) == (as_tuples(want) if want else [])
    with pytest.raises(ValueError, match="goes on to"):
        refresh_by_difference(spark, first, target, keys, two, "late")
    for bad in (state((1, "a", 1.0), (1, "b", 1.0)), state((None, "a", 1.0))):
        with pytest.raises(Exception, match="not unique or null"):
            refresh_by_difference(spark, bad, target, keys, date(2027, 1, 1), "bad")


def test_quantile_from_sketches_is_exact(spark, tmp_path):
    losses = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'hot', 'g' || id % 7) as k", "if(id % 100 = 0, null, pmod(hash(id), 100000) / 8) as v")
    for i in range(4):
        for _ in range(1 + (i == 2)):           # one load is written twice
            sketches.store_sketches(losses.where(F.pmod(F.hash("v"), F.lit(4)) == i), str(tmp_path), f"l{i}",
                                    ["k"], "v", size=200)
    stored = sketches.read_sketches(spark, str(tmp_path))
    assert stored.count() == 4 * 8
    for p in (0.0, 0.5, 0.95, 1.0):
        want = as_tuples(losses.groupBy("k").agg(F.expr(f"percentile_disc({p}) within group (order by v)").alias("q")))
        assert as_tuples(sketches.quantile_of_loads(losses, stored, ["k"], "v", "q", p)) == want
        # without a margin most brackets miss their rank: these groups go the other way
        assert as_tuples(sketches.quantile_of_loads(losses, stored, ["k"], "v", "q", p, margin=0.0)) == want


def test_brackets_are_cut_into_ranges(spark, monkeypatch):
    values = spark.range(20_000).selectExpr("id % 2 as k", "if(id % 5 = 0, 7.5, id * id / 16) as v")
    want = as_tuples(values.groupBy("k").agg(F.expr("percentile_disc(0.95) within group (order by v)").alias("q")))
    for ranges in (1, 3, 1024):
        monkeypatch.setattr(scenarios, "RANGES", ranges)
        assert as_tuples(scenarios.quantile_by(values, ["k"], "v", "q", accuracy=20)) == want
    one = spark.range(10).selectExpr("1 as k", "3.0 as v")
    assert as_tuples(scenarios.quantile_by(one, ["k"], "v", "q")) == [(1, 3.0)]
    ends = spark.createDataFrame([(1, float("-inf")), (1, 2.0), (1, float("inf"))], "k int, v double")
    for p, q in ((0.1, float("-inf")), (0.5, 2.0), (0.95, float("inf"))):
        assert as_tuples(scenarios.quantile_by(ends, ["k"], "v", "q", p)) == [(1, q)]
