"""As-of joins and rule tables against brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curvemill import staging
from curvemill.operators.asof import as_of_join, shock_set_as_of
from curvemill.operators.rules import match_rules
from tests.conftest import as_tuples


@pytest.mark.parametrize("rows_of_a_copy", [0, 100_000])
def test_as_of_join_equals_brute_force(rows, monkeypatch, rows_of_a_copy):
    monkeypatch.setattr(staging.Staged, "fits", lambda self, limit=0: self.rows <= rows_of_a_copy)
    rng = random.Random(1)
    day = lambda: None if rng.random() < 0.05 else date(2025, 1, 1) + timedelta(rng.randrange(700))
    key = lambda: rng.choice(["EUR"] * 10 + ["USD", "GBP", None, "CHF"])
    rates = [(key(), day(), rng.choice([None, rng.random()]), rng.randrange(3)) for _ in range(300)]
    asked = [(i, key() if i % 3 else "EUR", date(2026, 1, 1) if i % 3 == 0 else day()) for i in range(600)]
    asked += [(-1, "EUR", date(2024, 1, 1)), (-2, "JPY", date(2026, 1, 1))]
    want = []
    for i, k, d in asked:
        before = [r for r in rates if r[0] == k and k and r[1] and d and r[1] <= d]
        best = max(before, key=lambda r: (r[1], r[3], (r[1], r[2] is not None, r[2] or 0)), default=None)
        want.append((i, k, d, best[1] if best else None, best[2] if best else None))
    found = as_of_join(rows(asked, "i int, k string, d date"),
                       rows(rates, "k string, since date, rate double, seq int"),
                       ["k"], "d", "since", ["since", "rate"], ["seq"])
    assert as_tuples(found) == sorted(want, key=repr)
    assert sum(w[3] is not None for w in want) > 300


def test_as_of_join_of_timestamps_without_keys_and_of_empty_tables(rows):
    asked = rows([(datetime(2026, 1, 1, 12, 0, s),) for s in (0, 1, 2, 3)], "at timestamp_ntz")
    table = rows([(datetime(2026, 1, 1, 12, 0, 1), "x"), (datetime(2026, 1, 1, 12, 0, 3), "y")],
                 "since timestamp_ntz, v string")
    piece = lambda t: F.second(t)
    found = as_of_join(asked, table, [], "at", "since", ["v"], piece=piece)
    assert [r.v for r in found.orderBy("at").collect()] == [None, "x", "x", "y"]
    assert as_of_join(asked.limit(0), table, [], "at", "since", ["v"]).count() == 0
    assert as_of_join(asked, table.where("false"), [], "at", "since", ["v"]).where("v is null").count() == 4
    with pytest.raises(ValueError, match="cast one of them"):
        as_of_join(asked.select(F.col("at").cast("date")), table, [], "at", "since", ["v"])


@pytest.mark.parametrize("on_file, expected", [
    ([date(2026, 3, 31), date(2026, 6, 30)], date(2026, 6, 30)), ([date(2026, 3, 31)], date(2026, 3, 31)),
    ([date(2026, 3, 31), date(2026, 9, 30)], date(2026, 3, 31)), ([date(2026, 9, 30)], None), ([], None)])
def test_shock_set_as_of(rows, on_file, expected):
    found = shock_set_as_of(rows([(date(2026, 4, 30),)], "day date"),
                            rows([(d,) for d in on_file], "effective date"), "day", "effective")
    assert as_tuples(found) == [(date(2026, 4, 30), expected)]


RULES = "rule int, form string, pattern string, scope string, result string"


def by_hand(rules, value, scope):
    hits = [(r[0], r[4]) for r in rules if (r[3] is None or r[3] == scope) and (
        r[1] == "default" or value is not None and r[2] is not None and (
            value == r[2] if r[1] == "exact" else value.endswith(r[2])))]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("rows_of_a_copy", [0, 100_000])
def test_rules_equal_brute_force(rows, monkeypatch, rows_of_a_copy):
    monkeypatch.setattr(staging.Staged, "fits", lambda self, limit=0: self.rows <= rows_of_a_copy)
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abü") for _ in range(n))
    rules = [(rng.randrange(40), rng.choice(["exact", "suffix"]), word(rng.randrange(5)),
              rng.choice([None, "x", "y"]), f"r{i}") for i in range(60)]
    rules += [(30, "default", None, "x", "dx"), (50, "default", "ignored", None, "d"), (1, "exact", None, None, "n")]
    data = [(rng.choice([None, word(rng.randrange(6)), "aab"]), rng.choice(["x", "y", "z", None]))
            for _ in range(500)]
    found = match_rules(rows(data, "v string, s string"), rows(rules, RULES), "v", "got", "s")
    assert as_tuples(found) == sorted(((v, s, by_hand(rules, v, s)) for v, s in data), key=repr)
    plain = [(*r[:3], None, r[4]) for r in rules]
    found = match_rules(rows(data, "v string, s string"), rows(plain, RULES).drop("scope"), "v", "got")
    assert as_tuples(found) == sorted(((v, s, by_hand(plain, v, None)) for v, s in data), key=repr)


def test_no_rules_and_unknown_forms(rows):
    df = rows([("a",), (None,)], "v string")
    assert as_tuples(match_rules(df, rows([], RULES).drop("scope"), "v", "got")) == [("a", None), (None, None)]
    with pytest.raises(Exception, match="unknown form of a rule: prefix"):
        match_rules(df, rows([(1, "prefix", "a", None, "r")], RULES).drop("scope"), "v", "got").collect()
