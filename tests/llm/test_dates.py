"""Pseudonyms of dates: the writing stays, every date of a writing is taken once."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from curvemill.llm import pii

ALL = [date(1900, 1, 1) + timedelta(i) for i in range(73_049)]
WRITINGS = {"iso": lambda d: f"{d:%Y-%m-%d}", "dotted": lambda d: f"{d:%d.%m.%Y}",
            "short": lambda d: f"{d.day}.{d.month}.{d.year}", "slashes": lambda d: f"{d:%m/%d/%Y}",
            "short slashes": lambda d: f"{d.month}/{d.day}/{d.year}", "day first": lambda d: f"{d:%d/%m/%Y}",
            "mixed": lambda d: f"{d.day}/{d:%m/%Y}"}


def valid(text):
    if "-" in text:
        return date.fromisoformat(text)
    a, b, y = (int(x) for x in text.replace("/", ".").split("."))
    return date(y, b, a) if "." in text or a > 12 else date(y, a, b)


def test_every_date_of_every_writing(spark):
    texts = sorted({w(d) for w in WRITINGS.values() for d in ALL[::3] + ALL[-800:]
                    } | {w(date(y, 2, 29)) for w in WRITINGS.values() for y in range(1904, 2100, 4)})
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    done, found = pii.pseudonymise(rows, "k")
    pairs = done.select(F.col(found)[0]["old"].alias("old"), "text").collect()
    assert {p.old for p in pairs} == set(texts)
    assert len({p.text for p in pairs}) == len(pairs) > 100_000
    kept = 0
    for old, new in pairs:
        valid(new)
        assert [len(x) for x in old.replace("/", ".").replace("-", ".").split(".")] == [
            len(x) for x in new.replace("/", ".").replace("-", ".").split(".")]
        assert [c for c in old if not c.isdigit()] == [c for c in new if not c.isdigit()]
        if "/" in old:
            assert (int(old.split("/")[0]) > 12) == (int(new.split("/")[0]) > 12)
        kept += old == new
    assert kept < 50


def test_a_whole_writing_is_permuted(spark):
    for write in ("iso", "dotted", "slashes"):
        texts = [WRITINGS[write](d) for d in ALL]
        done, _ = pii.pseudonymise(spark.createDataFrame([(t,) for t in texts], "text string").repartition(8), "k")
        assert {r.text for r in done.collect()} == set(texts)
