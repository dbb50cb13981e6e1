"""Scores by a class-based bigram model whose classes come from exchange clustering.

Every word of the training texts gets a class. The most frequent words, the core, are exchanged
first: in every round they are looked at in parallel, each for the class that raises the
likelihood of the class bigrams most. Then every other word is taken out of the open class, where
all of them lie at first, into the class that raises it most, by the classes on both sides of all
its places. A text is scored by class transitions and by the probability of each word in its class.

All words of all training texts are counted and kept in a table with their classes. Texts are read
into words twice: for the counts, and into paths, the numbers of their words of a bounded near part,
from which arrays all else is taken. All other words meet their class in a shuffle join and come
back to the places of their texts, so that transitions between two of them are exact too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.llm.common import write

CORE = 1000             # most frequent words, exchanged among themselves before all others
CLASSES = 32            # classes of all words
NEAR_WORDS = 50_000     # most frequent words that every task holds, below EDGE
LONGEST_NEAR = 64       # bytes of such a word at most
ROUNDS = 8
FLUSH = 300_000
PLACED = 2_000          # words that are placed together

RARE, END = CORE, CORE + 1                      # ids of all other words and of the end of a text
OPEN, STOP, STATES = CLASSES, CLASSES + 1, CLASSES + 2  # class of unseen words, of the end; all
EDGE, FAR = 2**16 - 2, 2**16 - 1                # in paths: the end, and words that are not near
MANY = 2**24 - 1        # places from which on a far word's count is not sent along with its places


def words_of(text: bytes | None) -> list[bytes]:
    """What lies between ASCII blanks, A-Z in lower case."""
    return [] if text is None else text.lower().split()


def held_out(key: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(7)) == 2,
                      F.lit(False))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch["text"]:
            total.update(words_of(text))
            if len(total) > FLUSH:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total.clear()
    yield pd.DataFrame({"word": pd.Series(list(total), dtype=object),
                        "n": pd.Series(list(total.values()), dtype="int64")})


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    """The paths of a batch in one line, with an end before, between and after them."""
    edge = np.uint16(EDGE).tobytes()
    return np.frombuffer(b"".join([edge, edge.join(batch.column("path").to_pylist()), edge]),
                         np.uint16)


def _states(of: np.ndarray, other: int, end: int) -> np.ndarray:
    """What each number of a path stands for: ``of`` it, else ``other`` or the end."""
    states = np.full(2**16, other, np.int64)
    states[:len(of)] = of
    states[EDGE] = end
    return states


def _pairs(core: int):
    size, ids = CORE + 2, _states(np.arange(core), RARE, END)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            flat = ids[_flat(batch)]
            total += np.bincount(flat[:-1] * size + flat[1:], minlength=size * size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (seen // size, seen % size, total[seen])], ["a", "b", "n"])
    return count


def _gain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _likelihood(table: np.ndarray) -> float:
    return float(_gain(table).sum() - _gain(table.sum(0)).sum() - _gain(table.sum(1)).sum())


def _exchange(of: np.ndarray, table: np.ndarray):
    """Best class per word, all else as it is: rows of (word, class, gain)."""
    classes = table.shape[0]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = _likelihood(table)
        for batch in batches:
            best = []
            for word, after, before in zip(batch["word"], batch["after"], batch["before"]):
                own = of[word]
                right, left, self_ = np.zeros(classes), np.zeros(classes), 0.0
                for x in after:
                    if x["id"] == word:
                        self_ = x["n"]
                    else:
                        right[of[x["id"]]] += x["n"]
                for x in before:
                    if x["id"] != word:
                        left[of[x["id"]]] += x["n"]
                bare = table.copy()
                bare[own] -= right
                bare[:, own] -= left
                bare[own, own] -= self_
                scores = np.full(CLASSES, -np.inf)
                for c in range(CLASSES):
                    moved = bare.copy()
                    moved[c] += right
                    moved[:, c] += left
                    moved[c, c] += self_
                    scores[c] = _likelihood(moved)
                to = int(scores.argmax())
                best.append((word, to, scores[to] - now))
            yield pd.DataFrame(best, columns=["word", "to", "gain"])
    return look


def _class_table(pairs: DataFrame, of: np.ndarray) -> np.ndarray:
    size = CLASSES + 2
    named = F.lit(of.tolist())
    cells = pairs.groupBy(F.get(named, F.col("a")).alias("c"), F.get(named, F.col("b")).alias("d")) \
        .agg(F.sum("n").alias("n")).collect()  # at most size * size rows
    table = np.zeros((size, size))
    for r in cells:
        table[r.c, r.d] = r.n
    return table


def clusters(pairs: DataFrame, words: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of every id and the table of class bigrams.

    ``pairs`` (a, b, n) has at most (CORE + 2) squared rows. Half of the words move in
    each round, so that neighbours do not change places for ever.
    """
    of = np.arange(CORE + 2) % CLASSES
    of[RARE], of[END] = CLASSES, CLASSES + 1
    ends = F.collect_list(F.struct(F.col("other").alias("id"), "n"))
    after = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), "n") \
        .groupBy("word").agg(ends.alias("after"))
    before = pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), "n") \
        .groupBy("word").agg(ends.alias("before"))
    none = F.array().cast("array<struct<id:bigint,n:bigint>>")
    profile = write(after.join(before, "word", "full").where(F.col("word") < words).select(
        "word", *[F.coalesce(c, none).alias(c) for c in ("after", "before")]), "lm-profiles").df
    table = _class_table(pairs, of)
    for turn in range(rounds):
        moves = profile.where(F.col("word") % 2 == turn % 2).repartition(
            int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word").mapInPandas(
            _exchange(of, table), "word bigint, to bigint, gain double").where("gain > 0").collect()
        if not moves and turn:
            break
        for m in moves:  # at most CORE rows
            of[m.word] = m.to
        table = _class_table(pairs, of)
    return of, table


def _near_contexts(core: int, of: np.ndarray):
    """Rows of (near word beyond the core, pair of the classes on both sides, places)."""
    states, pairs = _states(of, OPEN, STOP), STATES * STATES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _flat(batch)
            path, at = states[flat], np.flatnonzero((flat >= core) & (flat < EDGE))
            seen, n = np.unique(flat[at] * np.int64(pairs) + path[at - 1] * STATES + path[at + 1],
                                return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (seen // pairs, (seen % pairs).astype(np.int32), n)],
                ["word", "context", "n"])
    return count


def _far_contexts(of: np.ndarray):
    """Rows of (word that is not near, pair of the classes on both sides), one per place."""
    states = _states(of, OPEN, STOP)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, far = states[_flat(batch)], batch.column("far")
            ends = np.flatnonzero(_flat(batch) == EDGE)[:-1]
            words = far.flatten()
            at = words.field("at").to_numpy() + 1 + np.repeat(ends, far.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [words.field("word"), pa.array((path[at - 1] * STATES + path[at + 1]).astype(np.int32))],
                ["word", "context"])
    return contexts


def best_classes(table: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood of ``table`` most, the least of equals.

    ``left`` and ``right`` (words x states) count what stands before and after each word, which
    itself lies in the open class; a word beside itself counts as beside another open word.
    """
    row, col, cross = (x[:CLASSES] for x in (table.sum(1), table.sum(0), np.diag(table)))

    def added(cells: np.ndarray, by: np.ndarray, own: np.ndarray) -> np.ndarray:
        word, state = np.nonzero(by)
        base, n = cells[state], by[word, state][:, None]
        in_open = state == OPEN     # cells of the open class lose what the word leaves
        base[in_open] -= own[word[in_open], :CLASSES]
        return np.add.reduceat(_gain(base + n) - _gain(base),
                               np.searchsorted(word, np.arange(len(by))))

    n = right.sum(1)[:, None]
    gain = added(table[:, :CLASSES], left, right) + added(table[:CLASSES].T, right, left) \
        - (_gain(row + n) - _gain(row)) - (_gain(col + n) - _gain(col))
    x, y = left[:, :CLASSES], right[:, :CLASSES]     # a class beside its own word: one cell
    both = np.flatnonzero(((x > 0) & (y > 0)).any(1))
    x, y = x[both], y[both]
    gain[both] += _gain(cross + x + y) - _gain(cross + x) - _gain(cross + y) + _gain(cross)
    return gain.argmax(1)


def _place(table: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PLACED):
                part = batch.slice(start, PLACED)
                places, rows = part.column("places"), part.num_rows
                flat = places.flatten()
                context, n = flat.field("context").to_numpy(), flat.field("n").to_numpy()
                word = np.repeat(np.arange(rows), places.value_lengths().to_numpy()) * STATES
                sides = [np.bincount(word + side, n, rows * STATES).reshape(rows, STATES)
                         for side in (context // STATES, context % STATES)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("word"), pa.array(sides[1].sum(1).astype(np.int64)),
                     pa.array(best_classes(table, *sides).astype(np.int32))], ["word", "n", "c"])
    return place


@dataclass(frozen=True)
class Words:
    """Counts and classes of all training words: the ``near`` ones, most frequent first, as a list
    with their classes ``of``, and all ``others`` as a table (word, n, c)."""

    near: list[tuple[bytes, int]]
    of: np.ndarray
    others: DataFrame
    tokens: int
    texts: int
    distinct: int


def _walk(near: list[tuple[bytes, int]], tokens: int, texts: int, distinct: int):
    """Per text its path, sums over its near words, and its far words."""
    index = {w: i for i, (w, _) in enumerate(near)}
    numbers = np.append(np.arange(len(near)), FAR).astype(np.uint16)
    count = np.array([n for _, n in near] + [0], float)
    base = np.log10((count + 1) / (tokens + distinct + 1))
    logs = np.log10(np.maximum(count, 1))
    base[-1] = 0.0      # words that are joined later
    end = np.log10((texts + 1) / (tokens + distinct + 1))
    seen = int(texts > 0)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, start = batch.column("text"), 0
            sums, paths, sizes, places, far = [], [], [0], [], []

            def done(until: int) -> pa.RecordBatch:
                part = batch.slice(start, until - start)
                n, known, b, m = zip(*sums)
                words = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(places).astype(np.int32)), pa.array(far, pa.binary())],
                    ["at", "word"])
                return pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "held_out", "uid")]
                    + [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(b), pa.array(m),
                       pa.array(paths, pa.binary()),
                       pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), words)],
                    ["doc_id", "held_out", "uid", "n_tokens", "n_known", "base", "logs", "path",
                     "far"])

            for i in range(batch.num_rows):
                words = words_of(column[i].as_py())
                ids = np.fromiter((index.get(w, -1) for w in words), np.int64, len(words))
                at = np.flatnonzero(ids < 0)
                sums.append((len(words) + 1, len(words) - len(at) + seen,
                             float(base[ids].sum() + end), float(logs[ids].sum())))
                paths.append(numbers[ids].tobytes())
                sizes.append(len(at))
                places.append(at)
                far += [words[j] for j in at.tolist()]
                if len(far) > FLUSH or i + 1 == batch.num_rows:
                    yield done(i + 1)
                    start = i + 1
                    sums, paths, sizes, places, far = [], [], [0], [], []
    return walk


SUMS = "n_tokens bigint, n_known bigint, base double, logs double"


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[Words, DataFrame]:
    """A class for every word of the training rows, and the paths of all rows, written."""
    rows = docs.where(~held_out(key)).select(F.col(text).cast("binary").alias("text"))
    counts = write(rows.mapInPandas(_count, "word binary, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")), "lm-words", codec="zstd").df
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.count(F.lit(1)).alias("v")).first()
    texts = rows.count()
    tokens, distinct = total.n + texts, total.v + (texts > 0)
    near = [(bytes(r.word), r.n) for r in counts.where(F.octet_length("word") <= LONGEST_NEAR)
            .orderBy(F.desc("n"), "word").limit(NEAR_WORDS).collect()]
    kind = docs.schema[key].dataType.simpleString()
    paths = write(docs.select(
        F.col(key).alias("doc_id"), held_out(key).alias("held_out"),
        F.monotonically_increasing_id().alias("uid"), F.col(text).cast("binary").alias("text"))
        .mapInArrow(_walk(near, tokens, texts, distinct),
                    f"doc_id {kind}, held_out boolean, uid bigint, {SUMS}, path binary, "
                    "far array<struct<at int, word binary>>"), "lm-near", codec="zstd").df
    learned = paths.where(~F.col("held_out"))
    core = min(CORE, len(near))
    pairs = write(learned.select("path").mapInArrow(_pairs(core), "a bigint, b bigint, n bigint")
                  .groupBy("a", "b").agg(F.sum("n").alias("n")), "lm-pairs").df
    first, table = clusters(pairs, core)
    of = np.full(len(near), OPEN)
    of[:core] = first[:core]

    def placed(contexts: DataFrame, n) -> DataFrame:
        places = contexts.groupBy("word", "context").agg(n.alias("n")).groupBy("word").agg(
            F.collect_list(F.struct("context", "n")).alias("places"))   # at most STATES * STATES
        word = contexts.schema["word"].dataType.simpleString()
        return places.mapInArrow(_place(table), f"word {word}, n bigint, c int")

    moved = placed(learned.select("path").mapInArrow(
        _near_contexts(core, of), "word bigint, context int, n bigint"), F.sum("n")).collect()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = write(placed(learned.select("path", "far").mapInArrow(
        _far_contexts(of), "word binary, context int").repartition(parts, "word"),
        F.count(F.lit(1))), "lm-classes", codec="zstd").df
    for r in moved:     # at most NEAR_WORDS rows
        of[r.word] = r.c
    return Words(near, of, others, tokens, texts, distinct), paths


def _classes_on(of: np.ndarray, keep: list[str]):
    """Paths with a byte per word, its class; far words are in the open class."""
    states = _states(of, OPEN, STOP).astype(np.uint8)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [states[np.frombuffer(p, np.uint16)].tobytes()
                     for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(paths, pa.binary())], [*keep, "path"])
    return name


def _cells(under: float, many: int):
    """Per text its sums with those of its far words, its class bigrams and how often each occurs."""
    keep = ["doc_id", "held_out", "n_tokens"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = bytes([STOP])
        for batch in batches:
            cells, times, sizes = [], [], [0]
            line = np.frombuffer(b"".join(
                [edge, edge.join(batch.column("path").to_pylist()), edge]), np.uint8).astype(np.int64)
            ends, late = np.flatnonzero(line == STOP), batch.column("late")
            lengths, words = late.value_lengths().fill_null(0).to_numpy(), late.flatten().to_numpy()
            text, n = np.repeat(np.arange(batch.num_rows), lengths), words >> 8 & 2**24 - 1
            line[(words >> 32) + 1 + ends[text]] = words & 255
            here = n < many     # the others are summed before
            sums = [batch.column(c).to_numpy() + np.bincount(text, x, batch.num_rows) for c, x in (
                ("base", np.where(here, np.log10((n + 1) / under), 0.0)),
                ("logs", np.where(here, np.log10(np.maximum(n, 1)), 0.0)))]
            known = batch.column("n_known").to_numpy() + np.bincount(
                text, n > 0, batch.num_rows).astype(np.int64)
            pair = line[:-1] * STATES + line[1:]
            for i in range(batch.num_rows):
                cell, n = np.unique(pair[ends[i]:ends[i + 1]], return_counts=True)
                cells.append(cell)
                times.append(n)
                sizes.append(len(cell))
            none = [np.zeros(0)]
            bigrams = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x or none).astype(np.int32)) for x in (cells, times)],
                ["cell", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(x) for x in (known, *sums)]
                + [pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), bigrams)],
                [*keep, "n_known", "base", "logs", "bigrams"])
    return count


def bigrams(known: Words, paths: DataFrame) -> DataFrame:
    """Per row of ``paths`` its counts, sums of logarithms and class bigrams, written.

    A far word's place comes back as one number of its place, its count and its class.
    """
    far = paths.select("uid", F.explode("far").alias("f")).select("uid", "f.at", "f.word")
    n, zero = F.coalesce("n", F.lit(0)), F.lit(0.0)
    under, many = float(known.tokens + known.distinct + 1), F.col("n") >= MANY
    packed = F.shiftleft(F.col("at").cast("bigint"), 32) + F.least(n, F.lit(MANY)) * 256 \
        + F.coalesce("c", F.lit(OPEN))
    late = far.join(known.others, "word", "left").groupBy("uid").agg(
        F.sum(F.when(many, F.log10((n + 1) / F.lit(under))).otherwise(zero)).alias("b"),
        F.sum(F.when(many, F.log10(n)).otherwise(zero)).alias("m"),
        F.collect_list(packed).alias("late"))
    kind, keep = paths.schema["doc_id"].dataType.simpleString(), [
        c for c in paths.columns if c not in ("path", "far")]
    named = paths.drop("far").mapInArrow(
        _classes_on(known.of, keep), f"doc_id {kind}, held_out boolean, uid bigint, {SUMS}, path binary")
    whole = named.join(late, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", (F.col("base") + F.coalesce("b", zero)).alias("base"),
        (F.col("logs") + F.coalesce("m", zero)).alias("logs"), "path", "late")
    return write(whole.mapInArrow(
        _cells(under, MANY), f"doc_id {kind}, held_out boolean, {SUMS}, "
        "bigrams array<struct<cell int, n int>>"), "lm-bigrams", codec="zstd").df


def transitions(table: np.ndarray) -> np.ndarray:
    """log10 of the smoothed probability of each class after each class."""
    return np.log10((table + 1) / (table.sum(axis=1, keepdims=True) + STATES))


def bigram_table(rows: DataFrame) -> np.ndarray:
    """Class bigrams of the training rows among those of ``bigrams``."""
    table = np.zeros(STATES * STATES)
    for r in rows.where(~F.col("held_out")).select(F.explode("bigrams").alias("g")).groupBy(
            "g.cell").agg(F.sum("g.n").alias("n")).collect():    # at most STATES * STATES rows
        table[r.cell] = r.n
    return table.reshape(STATES, STATES)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    A known word has the probability of its class after the class before it, times its share in
    its class; all unseen words are one word in a class of its own, so the probabilities after
    any class add up to 1. A null text is empty: one end token. A null key is never held out.
    Repeated rows are trained on and scored as often as they occur. Without training rows every
    word is new. A very long text is one row in one task, its far words are joined apart.
    """
    known, paths = train(docs, key, text)
    rows = bigrams(known, paths)
    table = bigram_table(rows)
    share = np.log10(np.maximum(table.sum(axis=0), 1))
    share[[OPEN, STOP]] = 0.0
    weight = F.lit((transitions(table) - share).ravel().tolist())
    model = F.aggregate("bigrams", F.lit(0.0),
                        lambda s, g: s + F.get(weight, g["cell"]) * g["n"])
    return rows.select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", "n_known",
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("logs") + model).alias("score"))
