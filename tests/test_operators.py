import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from curvemill.operators import lookups, quality, shaping
from curvemill.staging import stage
from tests.conftest import as_tuples


def test_newest_per_key_has_a_total_order(rows):
    df = rows([("a", 1, 0.1), ("a", 2, 0.2), ("a", 2, 0.3), (None, 1, 0.9)],
              "k string, d int, v double")
    assert as_tuples(lookups.newest_per_key(df, ["k"], ["d"])) == sorted(
        [("a", 2, 0.3), (None, 1, 0.9)], key=repr)


def test_newest_with_ties_keeps_all_of_the_newest(rows):
    df = rows([("a", 1, 0.1), ("a", 2, 0.2), ("A ", 2, 0.3), (None, 1, 0.9)],
              "k string, d int, v double")
    from curvemill.functions.keys import normalize_text
    assert as_tuples(lookups.newest_with_ties(df, [normalize_text("k")], "d")) == sorted(
        [("a", 2, 0.2), ("A ", 2, 0.3), (None, 1, 0.9)], key=repr)


def test_lookup_keeps_unmatched_rows_and_null_keys(rows):
    df = rows([("a",), ("z",), (None,)], "k string")
    dim = rows([("a", 1.0), (None, 2.0)], "code string, rate double")
    expected = sorted([("a", 1.0), ("z", None), (None, None)], key=repr)
    assert as_tuples(lookups.lookup(df, dim, {"code": "k"}, ["rate"])) == expected
    assert as_tuples(lookups.lookup(df, stage(dim, "dim"), {"code": "k"}, ["rate"])) == expected


def test_rates_by_date_newest_load_wins_and_bad_dates_drop(rows):
    df = rows([(" usd ", "31-Aug-26", 1.1, 1), ("USD", "31-Aug-26", 1.2, 2),
               ("USD", "30-Sep-26", 1.3, 1), ("USD", "soon", 9.9, 3)],
              "code string, d string, rate double, load int")
    found = lookups.rates_by_date(df, "code", "rate", "d", "dd-MMM-yy", "load")
    assert as_tuples(found) == [("USD", date(2026, 8, 31), 1.2), ("USD", date(2026, 9, 30), 1.3)]


def test_tax_by_portfolio(rows):
    df = rows([("Book A", 1, "0.1"), ("BOOK  a", 2, "0.2"), ("book b", 1, "n/a")],
              "name string, day int, tax string")
    assert as_tuples(lookups.tax_by_portfolio(df, "name", "day", "tax")) == [
        ("book a", 0.2), ("book b", None)]


def filled(data):
    """Walk through the rows of each key in order and carry the last value."""
    out, last = [], {}
    for k, pos, a, b in sorted(data, key=lambda r: (str(r[0]), r[1])):
        la, lb = last.get(k, (None, None))
        last[k] = (la if a is None else a, lb if b is None else b)
        out.append((k, pos, *last[k]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece", [1000, 7, 1])
def test_forward_fill_equals_a_walk(rows, piece):
    r = random.Random(5)
    data = [(r.choice(["hot", "hot", "hot", "x", None]), i,
             r.choice([None, None, i]), r.choice([None, None, None, str(i)]))
            for i in range(300)]
    df = rows(data, "k string, pos int, a int, b string")
    found = shaping.forward_fill(df, ["a", "b"], ["pos"], F.floor(F.col("pos") / piece), ["k"])
    assert as_tuples(found) == filled(data)


def test_forward_fill_of_a_whole_sheet(rows):
    df = rows([(1, "a"), (2, None), (3, None), (4, "b"), (5, None)], "pos int, v string")
    found = shaping.forward_fill(df, ["v"], ["pos"], F.floor(F.col("pos") / 2))
    assert as_tuples(found) == [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b")]


def test_forward_fill_fails_where_pieces_overlap(rows):
    df = rows([(1, "a"), (2, None), (3, None)], "pos int, v string")
    with pytest.raises(Exception, match="chunk does not grow"):
        shaping.forward_fill(df, ["v"], ["pos"], F.col("pos") % 2).collect()


def test_shaping_helpers(rows):
    df = rows([("1", "x"), ("bad", None)], "`Old Name` string, tag string")
    df = shaping.rename_columns(df, ["Old Name"], ["new.name/1"])
    typed = shaping.override_types(shaping.normalize_names(df), {"NEW_NAME_1": "int"})
    assert typed.columns == ["NEW_NAME_1", "TAG"]
    assert as_tuples(typed) == sorted([(1, "x"), (None, None)], key=repr)
    assert shaping.exclude_values(typed, "TAG", ["x"]).count() == 1
    assert shaping.add_constants(typed, {"n": None}).schema["n"].dataType.simpleString() \
        == "string"
    assert shaping.name_positions(typed, [1], ["only"]).columns == ["only"]
    with pytest.raises(ValueError, match="Mandatory columns are missing: y"):
        shaping.require_columns(typed, ["tag", "y"])
    with pytest.raises(ValueError, match="collide"):
        shaping.normalize_names(rows([(1, 2)], "`a b` int, `a-b` int"))


def test_unions_match_by_name(rows):
    a, b = rows([(1, "x")], "n int, s string"), rows([("y", 2)], "s string, n int")
    assert as_tuples(shaping.union_feeds([a, b, b])) == [(1, "x"), (2, "y"), (2, "y")]
    assert as_tuples(shaping.tagged_union({"A": a, "B": b}, "tag")) == [
        (1, "x", "A"), (2, "y", "B")]


def test_checks(rows):
    df = rows([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, v int")
    known = rows([("a",), (None,)], "code string")
    assert as_tuples(quality.unmatched_keys(df, known, {"k": "code"})) == sorted(
        [("b",), (None,)], key=repr)
    assert as_tuples(quality.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert as_tuples(quality.missing_lookups(df, "k", ["v"])) == [(1,)]
    with pytest.raises(ValueError, match="the map has duplicate keys"):
        quality.require_unique(df, ["k"], "the map")
    quality.require_unique(df, ["k", "v"], "the map")
    with pytest.raises(ValueError, match="empty: none, nothing"):
        quality.require_rows({"none": df.where("false"), "some": df,
                              "nothing": known.where("false")})
    report = quality.input_report({"x": (df, {"no_key": F.col("k").isNull()})})
    assert as_tuples(report) == [("x", "no_key", 1), ("x", "rows", 4)]


def test_unmatched_shocks_and_incomplete_curves(rows):
    exposure = rows([("A", 3), ("A", 6), ("A", 1), ("B", 3)], "c string, t int")
    shocks = rows([("A", 3), ("B", 3)], "c string, t int")
    found = quality.unmatched_shocks(exposure, shocks, ["c"], "t")
    assert [(r[0], r[1]) for r in found.collect()] == [("A", [1, 6])]
    losses = rows([("a", 0, 3), ("b", 2, 3), ("c", 3, 0)], "k string, n int, m int")
    assert as_tuples(quality.incomplete_curves(losses, ["n", "m"], 3)) == [("b", 2, 3)]


def test_counting_rides_along(rows):
    df, seen = quality.counting(rows([(1,), (None,)], "v int"), missing=F.col("v").isNull())
    df.collect()
    assert seen.get == {"missing": 1}


def test_newest_stamp_types(rows):
    df = rows([("a", datetime(2026, 1, 1)), ("a", datetime(2026, 1, 2))], "k string, ts timestamp")
    assert lookups.newest_per_key(df, ["k"], ["ts"]).first()["ts"] == datetime(2026, 1, 2)
