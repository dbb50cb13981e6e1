"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

The index holds postings (term, row, position, surroundings) of training tokens for the
terms that can start a search: the rarest two of every benchmark window, by their counts in
all training texts. Lists are shifted by the offset of the term in the window and
intersected; what both lists agree on is compared with the whole window.

A window is also near a place if a stretch of as many words as the window has, and ``WITHIN``
more, holds all of its different terms but ``MISSING``, in any order. Such a stretch holds
one of the ``MISSING`` + 1 rarest terms, so their postings are enough to find all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.common import Written, fresh, lower_ascii, write

WINDOW = 10
WITHIN = 10             # words that may stand between the terms of a near window
MISSING = 1             # terms that a near window may lack; none below LEAST_TERMS
LEAST_TERMS = 5
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """Lower-case words of digits, a-z and all signs beyond ASCII, joined by blanks."""
    return F.btrim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD, " "))


def signs_words(text: Column) -> Column:
    """The words as an array; none for a null."""
    spaced = spaced_words(text)
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(
        F.split(spaced, " "))


def row_key(key: str, text: str) -> Column:
    """Names a row by its key and text; rows that are equal in both count as one."""
    return F.concat_ws(":", F.col(key).cast("string"),
                       F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


@dataclass(frozen=True)
class Index:
    """Search windows with their rarest terms, and the postings of those terms."""

    windows: Written
    postings: DataFrame
    within: int
    missing: int


def windows_of(items: DataFrame, item: str, text: str, length: int = WINDOW) -> DataFrame:
    """(item, words) for every run of ``length`` words, or the whole of a shorter item."""
    words = items.select(F.col(item).alias("item"), signs_words(F.col(text)).alias("w")) \
        .where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    return words.select("item", "w", F.explode(starts).alias("s")).select(
        "item", F.slice("w", F.col("s"), F.lit(length)).alias("words")).distinct()


def tokens_of(docs: DataFrame, key: str, text: str, keep: list[str], row: str, tokens: str,
              n_words: str) -> DataFrame:
    """The columns ``keep`` with the row key, the words joined by blanks and their number.

    Written once: all later passes only split at blanks.
    """
    joined = docs.select(*keep, row_key(key, text).alias(row),
                         spaced_words(F.col(text)).alias(tokens))
    blanks = F.char_length(tokens) - F.char_length(F.replace(tokens, F.lit(" "), F.lit("")))
    return write(joined.withColumn(n_words, F.when(F.col(tokens) == "", 0).otherwise(
        blanks + 1).cast("bigint")), "leak-tokens").df


def build_index(tokens: DataFrame, items: DataFrame, item: str, item_text: str,
                length: int = WINDOW, within: int = WITHIN, missing: int = MISSING) -> Index:
    """Count the test terms in all training texts, pick the rarest, store their postings.

    ``tokens``: row and tokens, the words of a text joined by blanks.

    Test terms and search terms are measured when written and only copied to all tasks up
    to ``common.COPY_ROWS`` and ``COPY_BYTES``; a larger set meets the tokens in a shuffle
    join. Surroundings are the words that any stretch around the posting can cover.
    """
    reach = length + within - 1
    windows = write(windows_of(items, item, item_text, length), "leak-windows").df
    texts = windows.select("words").distinct().withColumn(
        "window", F.md5(F.concat_ws(" ", "words").cast("binary")))
    terms = write(texts.select(F.explode("words").alias("term")).distinct(), "leak-terms",
                  ("term",))
    words = tokens.where("tokens <> ''").select("row", F.split("tokens", " ").alias("words"))
    counts = words.select(F.explode("words").alias("term")).join(terms.copied(), "term") \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    placed = texts.select("window", "words", F.posexplode("words").alias("offset", "term"))
    ranked = placed.join(counts, "term", "left").withColumn("place", F.row_number().over(
        Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "term", "offset")))
    found = write(ranked.where("place <= 2").groupBy("window", "words").agg(
        F.min(F.when(F.col("place") == 1, F.struct("term", "offset"))).alias("first"),
        F.min(F.when(F.col("place") == 2, F.struct("term", "offset"))).alias("second"))
        .join(ranked.groupBy("window").agg(F.sort_array(F.collect_set(F.struct(
            F.coalesce("n", F.lit(0)).alias("n"), "term")))["term"].alias("rarest")), "window"),
        "leak-search")
    anchors = F.slice("rarest", 1, lacking(F.col("rarest"), missing) + 1)
    search = write(found.df.select(F.explode(F.concat(F.filter(F.array(
        "first.term", "second.term"), lambda t: t.isNotNull()), anchors)).alias("term"))
        .distinct(), "leak-search-terms", ("term",))
    around = F.slice("words", F.greatest(F.col("position") - reach + 1, F.lit(1)),
                     F.least(F.col("position"), F.lit(reach)) + reach + 1)
    postings = words.select("row", "words", F.posexplode("words").alias("position", "term")) \
        .join(search.copied(), "term").select(
            "term", "row", "position", around.alias("around"),
            F.least(F.col("position"), F.lit(reach)).alias("before"))
    named = windows.withColumn("window", F.md5(F.concat_ws(" ", "words").cast("binary")))
    full = named.select("item", "window").join(found.df, "window")
    return Index(write(full, "leak-lookup"), write(postings, "leak-postings").df, within, missing)


def lacking(terms: Column, missing: int) -> Column:
    """How many of the different ``terms`` of a window a near place may lack."""
    return F.when(F.size(terms) < LEAST_TERMS, 0).otherwise(
        F.least(F.lit(missing), F.size(terms) - 1))


def phrase_matches(index: Index) -> DataFrame:
    """(row, start, n, window): exact places of windows, each once.

    Both lists of a window are shifted to the start of the window; starts in both lists are
    compared with the window word by word in the stored surroundings.
    """
    w = index.windows.df.select("window", "words", "first", "second").dropDuplicates(["window"])
    w = write(w.select(
        "window", "words", F.col("first.term").alias("term"), F.col("first.offset").alias("o1"),
        F.col("second.term").alias("term2"), F.col("second.offset").alias("o2")),
        "leak-window-terms", ("term", "term2"))
    size = F.size("words")
    first = index.postings.join(w.copied(), "term").select(
        "row", "window", "words", "term2", (F.col("position") - F.col("o1")).alias("start"),
        size.alias("n"), "around", (F.col("before") - F.col("o1") + 1).alias("at")) \
        .where("start >= 0 and at >= 1")
    second = index.postings.join(w.copied().drop("term", "words").withColumnRenamed(
        "term2", "term"), "term").select(
        "row", "window", (F.col("position") - F.col("o2")).alias("start"))
    alone = first.where("term2 is null")
    both = first.where("term2 is not null").join(second, ["row", "window", "start"])
    matched = alone.unionByName(both).where(
        F.slice("around", F.greatest("at", F.lit(1)), F.col("n")) == F.col("words"))
    return matched.select("row", "start", "n", "window")


def near_matches(index: Index) -> DataFrame:
    """(row, position, window): places of a rarest term in a stretch that is near a window.

    Every stretch counts that holds enough terms of the window; phrase matches are among them.
    """
    w = index.windows.df.select("window", "words", "rarest").dropDuplicates(["window"])
    less = lacking(F.col("rarest"), index.missing)
    w = write(w.select(
        "window", F.explode(F.slice("rarest", 1, less + 1)).alias("term"), "rarest",
        (F.size("rarest") - less).alias("need"),
        (F.size("words") + index.within).alias("span")), "leak-anchors", ("term",))

    def enough(words: Column) -> Column:
        return F.size(F.array_intersect(words, F.col("rarest"))) >= F.col("need")

    at = (F.col("before") + 1).cast("int")
    starts = F.sequence(F.greatest(at - F.col("span") + 1, F.lit(1)), at)
    return index.postings.join(w.copied(), "term").where(enough(F.col("around"))).where(
        F.exists(starts, lambda s: enough(F.slice("around", s, F.col("span"))))) \
        .select("row", "position", "window")


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", keep: list[str] | None = None,
         within: int = WITHIN, missing: int = MISSING) -> tuple[DataFrame, str]:
    """All rows with the columns ``keep`` (default: all) and a struct of what was found.

    The struct holds n_words, n_hit and the sorted distinct items with a window in the
    row; and n_near, the different windows that are near a place of the row, with the sorted
    distinct near_items, phrase matches included. A null text has no words; an item without words has no window; repeated rows get
    the same result each; an empty table on either side gives no hits.
    """
    keep = docs.columns if keep is None else keep
    row, words, leak = fresh(docs, "row"), fresh(docs, "tokens"), fresh(docs, "leak")
    stored = tokens_of(docs, key, text, keep, row, words, leak)
    index = build_index(stored.select(F.col(row).alias("row"), F.col(words).alias("tokens")),
                        items, item, item_text, within=within, missing=missing)
    matches = write(phrase_matches(index), "leak-matches", ("row",)).df
    places = matches.select("row", "start", "n").distinct().select(
        "row", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("p"))
    hits = places.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    near = write(near_matches(index).select("row", "window").distinct(), "leak-near", ("row",)).df

    def named(of: DataFrame, name: str) -> DataFrame:
        return of.select("row", "window").distinct().join(
            index.windows.df.select("window", "item"), "window").select("row", "item") \
            .distinct().groupBy("row").agg(F.array_sort(F.collect_list(
                F.col("item").cast("string"))).alias(name))

    found = near.groupBy("row").agg(F.count(F.lit(1)).alias("n_near")) \
        .join(named(near, "near_items"), "row", "left").join(hits, "row", "full") \
        .join(named(matches, "items"), "row", "left")
    found = write(found, "leak-found", ("row",)).copied()
    found = found.withColumnsRenamed({c: f"_{row}_{c}" for c in found.columns})
    joined = stored.drop(words).join(found, F.col(row) == F.col(f"_{row}_row"), "left")

    def count(name: str) -> Column:
        return F.coalesce(f"_{row}_{name}", F.lit(0)).cast("bigint").alias(name)

    def names(name: str) -> Column:
        return F.coalesce(f"_{row}_{name}", F.array().cast("array<string>")).alias(name)

    return joined.select(*keep, F.struct(
        F.col(leak).alias("n_words"), count("n_hit"), names("items"), count("n_near"),
        names("near_items")).alias(leak)), leak
