"""Quality rules on the level of hosts, in DataFrame functions only.

Every text is measured once. Failures are counted per host, the rate of each host is
shrunk with a beta prior fitted to all hosts, and the verdict on the host goes back to its
documents by a join on the host; one row per host meets them, so a host with a third of
all rows is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.llm.common import bind, blank_words, fresh, write

SYMBOLS = "#*$%&|<>"

# Rules of a document. A failure of one of the last three counts against the host; alone
# it rejects a document only on a strict host.
LEAST_WORDS = 50
MOST_REPEATED = 50      # percent of the words
MOST_SYMBOLS = 10       # percent of the signs in words
MOST_DUP_LINES = 30     # percent of the lines with a word

STRICT_RATE = 0.3       # shrunk failure rate above which a host is strict
REJECT_RATE = 0.5       # all of a host goes if its rate is above this by two deviations
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0


def _shift(name: str, x: Column, bits: Column) -> Column:
    return F.call_function(name, x, bits)


def _bits(words: Column) -> Column:
    return F.length(F.bin(F.size(words)))


def sorted_windows(words: Column) -> Column:
    """The three-word windows of a text as sorted longs: bits of a hash above the position."""
    windows = F.transform(words, lambda w, i: _shift(
        "shiftleft", F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), _bits(words))
        .bitwiseOR(i.cast("bigint")))
    return F.sort_array(F.slice(windows, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))))


def repeated_words(words: Column, windows: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more.

    Sorting has brought equal windows together; neighbours with equal bits of the hash are
    then compared word by word.
    """
    bits = _bits(words)

    def place(x: Column) -> Column:
        return F.pmod(x, _shift("shiftleft", F.lit(1).cast("bigint"), bits)).cast("int")

    def alike(k: Column) -> Column:
        x, y = F.get(windows, k), F.get(windows, k + 1)
        same = _shift("shiftright", x.bitwiseXOR(y), bits) == 0
        for i in range(3):
            same = same & (F.get(words, place(x) + i) == F.get(words, place(y) + i))
        return same

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, i: F.least(
            F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    twice = F.filter(F.sequence(F.lit(0), F.size(windows) - 2), alike)
    starts = bind(twice, lambda ks: F.sort_array(F.array_distinct(F.concat(
        F.transform(ks, lambda k: place(F.get(windows, k))),
        F.transform(ks, lambda k: place(F.get(windows, k + 1)))))))
    return F.when(F.size(windows) >= 2, bind(starts, covered)).otherwise(F.lit(0)) \
        .cast("bigint")


def measures(text: Column, words: Column, windows: Column) -> dict[str, Column]:
    """Counts of one text; a null has no words and no lines."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
        .cast("bigint"),
        "n_symbols": (F.char_length(text)
                      - F.char_length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("bigint"),
        "n_lines": bind(lines, lambda x: F.size(x)).cast("bigint"),
        "n_dup_lines": bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("bigint"),
        "n_repeat_words": repeated_words(words, windows),
    }


def host_rates(rows: DataFrame, host: str, failed: str) -> DataFrame:
    """Failures per host, shrunk: (host, n, rate, deviation).

    The prior has the rate of all rows as its mean and, by the method of moments, a
    strength that follows from the spread of the hosts, weighted by their rows.
    """
    hosts = rows.groupBy(F.coalesce(host, F.lit("")).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("f"))
    r, n, f = F.col("f") / F.col("n"), F.col("n"), F.col("f")
    prior = hosts.agg(F.sum("f").alias("f"), F.sum("n").alias("n"),
                      F.sum(n * r * r).alias("square")).select(
        (f / n).alias("mean"), (F.col("square") / n - (f / n) * (f / n)).alias("spread"))
    mean, spread = F.col("mean"), F.col("spread")
    strength = F.when(spread <= mean * (1 - mean) / MOST_PRIOR, F.lit(MOST_PRIOR)).otherwise(
        F.greatest(F.lit(LEAST_PRIOR), mean * (1 - mean) / spread - 1))
    prior = prior.select(mean, strength.alias("strength"))
    rate = (mean * F.col("strength") + f) / (F.col("strength") + n)
    # the prior is one row by construction
    return hosts.join(F.broadcast(prior)).select(
        "host", "n", rate.alias("rate"),
        F.sqrt(rate * (1 - rate) / (F.col("strength") + n + 1)).alias("deviation"))


def judge(df: DataFrame, text: str = "text", host: str = "source",
          keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All rows with the columns ``keep`` (default: all) and a struct with the findings.

    Returns the rows and the name of the struct: the measures, base_failed, soft_failed,
    host_rate, kept. A null text is empty and fails; a null host is the host "". Repeated
    rows count as often as they occur; an empty table gives an empty result.
    """
    keep = df.columns if keep is None else keep
    words, windows, rules = fresh(df, "words"), fresh(df, "windows"), fresh(df, "rules")
    found = measures(F.col(text), F.col(words), F.col(windows))
    counted = df.withColumn(words, blank_words(F.col(text))) \
        .withColumn(windows, sorted_windows(F.col(words))).select(
            *keep, F.struct(*[c.alias(n) for n, c in found.items()],
                            F.coalesce(host, F.lit("")).alias("host")).alias(rules))
    m = {n: F.col(f"{rules}.{n}") for n in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}
    base = (m["n_words"] < LEAST_WORDS) | (
        100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    soft = (100 * m["n_symbols"] > MOST_SYMBOLS * m["word_chars"]) \
        | (100 * m["n_dup_lines"] > MOST_DUP_LINES * m["n_lines"])
    counted = counted.withColumn(rules, F.col(rules).withField("base_failed", base)
                                 .withField("soft_failed", soft))
    rows = write(counted, "quality-rules").df
    failed = F.col(f"{rules}.base_failed") | F.col(f"{rules}.soft_failed")
    name, rate, rejected = (fresh(rows, x) for x in ("judged_host", "rate", "rejected"))
    found = host_rates(rows.select(F.col(f"{rules}.host").alias("host"), failed.alias("bad")),
                       "host", "bad").select(
        F.col("host").alias(name), F.col("rate").alias(rate),
        (F.col("rate") - 2 * F.col("deviation") > REJECT_RATE).alias(rejected))
    found = write(found, "quality-hosts", (name,)).copied()    # texts stay where they are
    joined = rows.join(found, F.col(f"{rules}.host") == F.col(name))
    kept = ~F.col(f"{rules}.base_failed") & ~F.col(rejected) & ~(
        F.col(f"{rules}.soft_failed") & (F.col(rate) > STRICT_RATE))
    return joined.select(*keep, F.col(rules).withField("host_rate", F.col(rate))
                         .withField("kept", kept).alias(rules)), rules
