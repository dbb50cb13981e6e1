"""Ordered rules as a table: the rule with the lowest number that matches decides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.staging import stage

EXACT, SUFFIX, DEFAULT = "exact", "suffix", "default"


def match_rules(df: DataFrame, rules: DataFrame, value: str, name: str,
                scope: str | None = None) -> DataFrame:
    """``df`` with the result of the first rule that matches ``value``; null if none does.

    ``rules`` has the columns rule (number), form, pattern, result and, if a ``scope`` column is
    named, scope: a rule without one holds in every scope. A rule of form exact holds for values
    equal to its pattern, of form suffix for values that end with it, of form default for all
    values, nulls too. Of several rules with one number the least result counts. Other forms fail.

    The rules are an index by form and pattern: each value asks for itself, for its suffixes of
    the lengths that rules have, and for the default, so a lookup costs a join and not one
    comparison per rule. Every distinct value asks once, however many rows hold it.
    """
    keys = [value, *([scope] if scope else [])]
    known = F.col("form").isin(EXACT, SUFFIX, DEFAULT)
    checked = F.when(known, F.col("form")).otherwise(F.raise_error(F.concat(
        F.lit("unknown form of a rule: "), F.coalesce("form", F.lit("null")))))
    index = rules.select(
        checked.alias("_form"), F.when(F.col("form") == DEFAULT, F.lit("")).otherwise(F.col("pattern"))
        .alias("_pattern"), *([F.col("scope").alias("_scope")] if scope else []),
        F.struct(F.col("rule"), F.col("result")).alias("_rule"))
    index = index.groupBy(*[c for c in index.columns if c != "_rule"]).agg(F.min("_rule").alias("_rule"))
    index = stage(index, "rule-index")
    index = F.broadcast(index.df) if index.fits() else index.df
    lengths = rules.where(F.col("form") == SUFFIX).agg(
        F.collect_set(F.char_length("pattern"))).scalar()
    values = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    value = F.col("_k0")
    ask = lambda form, pattern: F.struct(F.lit(form).alias("form"), pattern.alias("pattern"))
    asks = F.concat(
        F.array(ask(EXACT, value), ask(DEFAULT, F.lit(""))),
        F.transform(F.filter("_lengths", lambda n: n <= F.char_length(value)), lambda n: ask(
            SUFFIX, F.right(value, n))))
    asked = values.withColumn("_lengths", lengths).withColumn(
        "_ask", F.explode(F.coalesce(asks, F.array(ask(DEFAULT, F.lit(""))))))
    same = (F.col("_ask.form") == F.col("_form")) & (F.col("_ask.pattern") == F.col("_pattern"))
    if scope:
        same = same & (F.col("_scope").isNull() | (F.col("_scope") == F.col("_k1")))
    names = [f"_k{i}" for i in range(len(keys))]
    found = stage(asked.join(index, same).groupBy(*names).agg(F.min("_rule").alias("_rule")), "rules")
    side = F.broadcast(found.df) if found.fits() else found.df
    back = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return df.join(side, back, "left").select(*df.columns, F.col("_rule.result").alias(name))
