"""Hard-negative mining with summaries of vector segments.

Rows lie in blocks. A block keeps, besides its vectors, the mean and the deviation of every
segment of every vector, on levels of ever shorter segments. For a segment of s components the
product of two vectors is s * (mean * mean +- deviation * deviation), so a level of summaries
bounds the score of a pair from both sides. A pair goes on to the next level, and at last to
its exact score, only while its bounds can still hold a result.

Anchors lie in blocks as well, and every block of anchors meets every block of rows in a task of
its own. First each anchor gets its best rows of the same label, then, for the range of scores
that each of these allows, its best rows of other labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.common import write

ROWS = 4096                 # rows of a block, on average
ANCHORS = 2048              # anchors of a block, on average
TILE = 256                  # anchors that are compared at once
STEPS = (64, 256, 1024)     # rows compared at once: few, until limits are known
LEVELS = (1, 4, 16)         # segments of a vector on each level
SPARSE = 0.05               # share of pairs below which they are scored one by one
EXACT = 2.0 ** 26           # norms below it: all sums of products are exact as doubles
LEAST, MOST = -(2 ** 63) + 1, 2 ** 63 - 1

BLOCK = ("dim int, block int, uids binary, ids binary, unnamed binary, labels binary, "
         "vectors binary, means binary, deviations binary")
FOUND = ("anchor bigint, anchor_id bigint, place int, other bigint, other_id bigint, score bigint")


def prepared(rows: DataFrame, key: str, vector: str, label: Column, asked: Column,
             scale: float) -> DataFrame:
    """(uid, id, label, asked, dim, vector): the rows that take part, with whole components."""
    named = rows.select(F.monotonically_increasing_id().alias("uid"),
                        F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                        F.coalesce(asked, F.lit(False)).alias("asked"),
                        F.col(vector).cast("array<double>").alias("vector"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, labels = batch.column("vector"), batch.column("label")
            offsets = vectors.offsets.to_numpy()
            values = vectors.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                values = np.floor(values * scale)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            keep = np.flatnonzero((bad[offsets[1:]] == bad[offsets[:-1]])
                                  & ~vectors.is_null().to_numpy(zero_copy_only=False)
                                  & ~labels.is_null().to_numpy(zero_copy_only=False))
            sizes = (offsets[1:] - offsets[:-1])[keep]
            data = [values[offsets[i]:offsets[i + 1]].tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep)) for c in ("uid", "id", "label", "asked")]
                + [pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
                ["uid", "id", "label", "asked", "dim", "vector"])

    return named.mapInArrow(
        task, "uid bigint, id bigint, label bigint, asked boolean, dim int, vector binary")


def segments(dim: int) -> list[np.ndarray]:
    """The first component of every segment, per level."""
    return [np.unique(np.arange(n) * dim // n) for n in LEVELS if dim]


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment, the levels side by side."""
    n, dim = vectors.shape
    means, deviations = [np.zeros((n, 0))], [np.zeros((n, 0))]
    with np.errstate(all="ignore"):
        for starts in segments(dim):
            sizes = np.diff(np.append(starts, dim))
            mean = np.add.reduceat(vectors, starts, axis=1) / sizes
            apart = vectors - np.repeat(mean, sizes, axis=1)
            means.append(mean)
            deviations.append(np.sqrt(np.add.reduceat(apart * apart, starts, axis=1) / sizes))
    return np.hstack(means), np.hstack(deviations)


class Block:
    """The vectors of a block with their summaries; some rows of it after ``take``."""

    FIELDS = ("uids", "ids", "unnamed", "labels", "vectors", "means", "deviations", "norms")

    def __init__(self, dim: int, **columns: np.ndarray):
        self.dim = dim
        self.__dict__.update(columns)

    @classmethod
    def read(cls, table: pa.Table, row: int = 0) -> Block:
        cell = {c: table.column(c)[row].as_py() for c in table.column_names}
        uids = np.frombuffer(cell["uids"], np.int64)
        shaped = {c: np.frombuffer(cell[c], np.float64).reshape(len(uids), -1)
                  if cell["dim"] else np.zeros((len(uids), 0)) for c in ("vectors", "means", "deviations")}
        with np.errstate(all="ignore"):
            norms = np.sqrt((shaped["vectors"] ** 2).sum(axis=1))
        return cls(cell["dim"], uids=uids, ids=np.frombuffer(cell["ids"], np.int64),
                   unnamed=np.frombuffer(cell["unnamed"], np.bool_),
                   labels=np.frombuffer(cell["labels"], np.int64), norms=norms, **shaped)

    def take(self, rows) -> Block:
        return Block(self.dim, **{c: getattr(self, c)[rows] for c in self.FIELDS})

    def __len__(self) -> int:
        return len(self.uids)


def blocks(rows: DataFrame, count: int, seed: int) -> DataFrame:
    """Rows in ``count`` blocks per length of vector, with the summaries of their segments.

    A column ``windows`` (array of longs, one length for all) goes into the block as well.
    """
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(count)).cast("int"))
    form = BLOCK + (", windows binary" if "windows" in rows.columns else "")
    schema = pa.schema([(c, pa.int32() if k == "int" else pa.binary())
                        for c, k in (f.split() for f in form.split(", "))])

    def task(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, n = table.column("dim")[0].as_py(), table.num_rows
        vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(n, dim)
        means, deviations = summaries(vectors)
        ids = table.column("id")
        row = {"dim": dim, "block": table.column("block")[0].as_py(),
               "uids": table.column("uid").to_numpy().tobytes(),
               "ids": ids.fill_null(MOST).to_numpy().tobytes(),
               "unnamed": ids.is_null().to_numpy().tobytes(),
               "labels": table.column("label").to_numpy().tobytes(),
               "vectors": vectors.tobytes(), "means": means.tobytes(),
               "deviations": deviations.tobytes()}
        if "windows" in schema.names:
            row["windows"] = np.array(table.column("windows").to_pylist(), np.int64).tobytes()
        return pa.Table.from_pylist([row], schema)

    return dealt.groupBy("dim", "block").applyInArrow(task, form)


def scores(a: Block, b: Block, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Exact products, of all pairs or of some, as longs.

    Products beyond the doubles that hold every whole number are taken as integers of any size;
    what is beyond a long counts as the end of its range.
    """
    plain = max(a.norms.max(initial=0), b.norms.max(initial=0)) < EXACT
    a, b = (a.vectors, b.vectors) if pairs is None else (a.vectors[pairs[0]], b.vectors[pairs[1]])
    if plain:
        found = a @ b.T if pairs is None else np.einsum("ij,ij->i", a, b)
        return found.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    a, b = whole(a).astype(object), whole(b).astype(object)
    found = a @ b.T if pairs is None else (a * b).sum(axis=1)
    return np.clip(found, LEAST, MOST).astype(np.int64)


def candidates(a: Block, b: Block, low: np.ndarray, high: np.ndarray, allowed: np.ndarray):
    """(i, j, score) of the allowed pairs whose score lies from low to high of anchor i.

    Level by level only the pairs stay whose bounds reach into that range; rows that no anchor
    needs any more leave the level's matrices.
    """
    rows, alive, at = np.arange(len(b)), allowed, 0
    low = np.where(low <= LEAST, -np.inf, low.astype(np.float64))[:, None]
    high = np.where(high >= MOST, np.inf, high.astype(np.float64))[:, None]
    for starts in segments(a.dim):
        some = alive.any(axis=0)
        rows, alive = rows[some], alive[:, some]
        if not len(rows):
            break
        sizes, part = np.diff(np.append(starts, a.dim)), slice(at, at + len(starts))
        with np.errstate(all="ignore"):     # bounds that are no numbers rule nothing out
            middle = (a.means[:, part] * sizes) @ b.means[rows, part].T
            spread = (a.deviations[:, part] * sizes) @ b.deviations[rows, part].T
            spread += 1e-10 * np.outer(a.norms, b.norms[rows]) + 1.0     # their rounding
            alive = alive & ~(middle + spread < low) & ~(middle - spread > high)
        at += len(starts)
    i, j = np.nonzero(alive)
    if len(i) <= SPARSE * alive.size:
        score = scores(a, b, (i, rows[j]))
    else:
        score = scores(a, b.take(rows))[i, j]
    return i, rows[j], score


def first_of(group: np.ndarray, score: np.ndarray, tie: np.ndarray, uid: np.ndarray, k: int):
    """Indices of the first k of each group: greatest score, then least tie, then least uid."""
    order = np.lexsort((uid, tie, -score, group))
    sorted_groups = group[order]
    begins = np.flatnonzero(np.append(True, sorted_groups[1:] != sorted_groups[:-1]))
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < k]


def steps(n: int) -> Iterator[slice]:
    """Rows 0 to n in runs that grow."""
    at, i = 0, 0
    while at < n:
        size = STEPS[min(i, len(STEPS) - 1)]
        yield slice(at, min(at + size, n))
        at, i = at + size, i + 1


def best_in_windows(a: Block, b: Block, low: np.ndarray, high: np.ndarray, k: int, same: bool):
    """(i, place, j, score): per anchor and window the first k rows of the same or another label.

    ``low`` and ``high`` hold one column per window. The limits rise with what is found.
    """
    limit = low.copy()
    width = low.shape[1]
    found = [np.zeros(0, np.int64) for _ in range(4)]       # anchor, place, row, score
    for run in steps(len(b)):
        part = b.take(run)
        allowed = a.labels[:, None] == part.labels if same else a.labels[:, None] != part.labels
        if same:
            allowed &= a.uids[:, None] != part.uids
        i, j, score = candidates(a, part, limit.min(axis=1), high.max(axis=1), allowed)
        inside = (score[:, None] >= limit[i]) & (score[:, None] <= high[i])
        pair, place = np.nonzero(inside)
        new = [i[pair], place, j[pair] + run.start, score[pair]]
        merged = [np.concatenate(x) for x in zip(found, new)]
        group = merged[0] * width + merged[1]
        kept = first_of(group, merged[3], b.ids[merged[2]], b.uids[merged[2]], k)
        found = [x[kept] for x in merged]
        group = group[kept]
        last = np.flatnonzero(np.append(group[1:] != group[:-1], True)[:len(group)])
        full = last[np.diff(np.append(-1, last)) == k]
        limit[found[0][full], found[1][full]] = found[3][full]
    return found


def _pairs(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], task) -> DataFrame:
    """``task(anchors, rows)`` for every block of anchors and every block of rows, one by one."""
    row_side = rows.withColumns({
        "a": F.explode(F.sequence(F.lit(0), F.lit(counts[0] - 1))), "r": F.col("block")})
    anchor_side = anchors.withColumns({
        "a": F.col("block"), "r": F.explode(F.sequence(F.lit(0), F.lit(counts[1] - 1)))})
    schema = pa.schema([(c, pa.int64() if k == "bigint" else pa.int32())
                        for c, k in (f.split() for f in FOUND.split(", "))])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        parts = [pa.table(part, schema) for part in task(left, right)]
        return pa.concat_tables([schema.empty_table(), *parts])

    return anchor_side.groupBy("dim", "a", "r").cogroup(row_side.groupBy("dim", "a", "r")) \
        .applyInArrow(meet, FOUND)


def _rows_of(a: Block, b: Block, found: list[np.ndarray]) -> list[pa.Array]:
    i, place, j, score = found
    return [pa.array(a.uids[i]), pa.array(a.ids[i], mask=a.unnamed[i]), pa.array(place.astype(np.int32)),
            pa.array(b.uids[j]), pa.array(b.ids[j], mask=b.unnamed[j]), pa.array(score)]


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and window, numbered from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(
        F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _same_label(left: pa.Table, right: pa.Table, k: int) -> Iterator[list[pa.Array]]:
    """The best rows of the anchors' own labels; only rows of one label are put together."""
    anchors, rows = Block.read(left), Block.read(right)
    for label in np.intersect1d(anchors.labels, rows.labels):
        a, b = (x.take(np.flatnonzero(x.labels == label)) for x in (anchors, rows))
        for at in range(0, len(a), TILE):
            tile = a.take(slice(at, at + TILE))
            ends = np.full((len(tile), 1), LEAST), np.full((len(tile), 1), MOST)
            yield _rows_of(tile, b, best_in_windows(tile, b, *ends, k, True))


def _other_labels(left: pa.Table, right: pa.Table, k: int) -> Iterator[list[pa.Array]]:
    """The best rows of other labels in the windows (least and greatest score) of the anchors."""
    anchors, rows = Block.read(left), Block.read(right)
    ends = np.frombuffer(left.column("windows")[0].as_py(), np.int64).reshape(len(anchors), -1, 2)
    for at in range(0, len(anchors), TILE):
        tile, part = anchors.take(slice(at, at + TILE)), ends[at:at + TILE]
        yield _rows_of(tile, rows, best_in_windows(tile, rows, part[:, :, 0], part[:, :, 1], k, False))


def _share(score: str, percent: int, up: bool) -> Column:
    """``percent`` hundredths of a long column, rounded up or down, without overflow."""
    part = F.col(score) % 100 * percent / 100
    return F.expr(f"{score} div 100") * percent + (F.ceil(part) if up else F.floor(part))


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
         label: str | Column = "label", anchors: Column | None = None, scale: float = 1.0,
         positives: int = 5, negatives: int = 3, low_percent: int = 50,
         high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors (all by default). An anchor's positives are its best
    other rows of the same label, its negatives for a positive the best rows of other labels
    whose score is from ``low_percent`` to ``high_percent`` hundredths of the positive's. Scores
    are products of components times ``scale``, rounded down; higher ones come first, then lesser
    keys, null keys last.

    Rows without label or vector, or with a component that is null or not finite (also after the
    multiplication), take no part; a null condition makes no anchor. Vectors of different lengths
    never meet; those without components all score 0. Repeated rows are rows of their own and may
    be each other's positives. Scores beyond a long count as its ends. Columns other than the
    three are not read, and an empty table gives an empty result.
    """
    label = F.col(label) if isinstance(label, str) else label
    asked = F.lit(True) if anchors is None else anchors
    table = write(prepared(rows, key, vector, label, asked, scale), "mine-rows")
    asked_rows = write(table.df.where("asked"), "mine-anchors")
    counts = max(1, -(-asked_rows.rows // ANCHORS)), max(1, -(-table.rows // ROWS))
    row_blocks = write(blocks(table.df, counts[1], 1), "mine-row-blocks").df

    def same(left, right, k=positives):
        return _same_label(left, right, k)

    def other(left, right, k=negatives):
        return _other_labels(left, right, k)

    best = write(_first(_pairs(row_blocks, blocks(asked_rows.df, counts[0], 2), counts, same), positives)
                 .select("anchor", "anchor_id", F.col("rank").alias("at"), F.col("other_id").alias(
                     "positive_id"), F.col("score").alias("positive_score")), "mine-positives").df
    low = _share("positive_score", low_percent, True)
    high = _share("positive_score", high_percent, False)
    none = F.array(F.lit(MOST), F.lit(LEAST))
    ends = [F.coalesce(F.max(F.when(F.col("at") == i + 1, F.array(low, high))), none)
            for i in range(positives)]
    windows = best.where(low <= high).groupBy("anchor").agg(F.concat(*ends).alias("windows"))
    ranged = asked_rows.df.join(windows, F.col("uid") == F.col("anchor")).drop("anchor")
    found = _first(_pairs(row_blocks, blocks(ranged, counts[0], 3), counts, other), negatives)
    found = found.select("anchor", (F.col("place") + 1).alias("at"), "rank",
                         F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(best, ["anchor", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
