"""Packing by non-negative least squares over length combinations.

Token ids are cut into windows; what is left of each document is a rest shorter than a
window. Combinations of two or three rests that fill a window exactly are enumerated, the
number of times that each is used is solved against the histogram of the rests and rounded,
and the rests beyond that are laid end to end and cut where a window ends. Each task does so for
the documents that it reads.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.common import write

WINDOW = 2048
END_ID = 1
SOLVER_STEPS = 150
CHUNK_TOKENS = 16_000_000   # that a task packs at once
BATCH_ROWS = 1000           # of results, each at most a window

# The fixed pre-split of byte-level BPE; safe for the signs below, which have one meaning.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COMMON = regex.compile(r"[\t-\r\x20-\x7e\xa0-ɏ]*")


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes -> id, if the file is byte-level BPE whose ids are in the order of its merges.

    Then the id of a token is the rank of its merge, which is all that an encoder by ranks needs.
    """
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    model, split = given["model"], given.get("pre_tokenizer") or {}
    plain = given.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get(
        "use_regex") and not split.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain or any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]     # bytes that stand for themselves
    hidden = (b for b in range(256) if b not in set(shown))
    signs = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    vocab = model["vocab"]
    if [vocab.get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    known = {bytes(signs[c] for c in t): i for t, i in vocab.items() if set(t) <= signs.keys()}
    return known if sorted(known.values()) == list(range(256 + len(merges))) else None


def tokenizer(path: str):
    """The tokenizer, and an encoder by ranks where one is possible, kept in a worker."""
    kept = sys.modules.setdefault("_curvemill_kept", ModuleType("_curvemill_kept")).__dict__
    if path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        ranks = merge_ranks(path)
        kept[path] = Tokenizer.from_file(path), ranks and tiktoken.Encoding(
            "ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def encoder(path: str):
    """Text -> little-endian ids. A text with rare signs or a special token goes through the
    tokenizer of the file; all others through the same merges, encoded by their ranks."""
    tok, by_rank = tokenizer(path)

    def encode(text: str) -> bytes:
        if by_rank is None or "<|" in text or not COMMON.fullmatch(text):
            return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return by_rank.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    return encode


def combinations(have: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, 0 for none, that fill the window; only lengths that occur."""
    lengths = np.flatnonzero(have[:window])
    lengths = lengths[lengths > 0]
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    c = window - a - b
    fits = (a >= b) & ((c == 0) | ((c > 0) & (b >= c) & (have[np.clip(c, 0, window)] > 0)))
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def solve(combos: np.ndarray, have: np.ndarray, steps: int = SOLVER_STEPS) -> np.ndarray:
    """Repeat counts >= 0 that come nearest to the histogram: accelerated projected gradient."""
    if not len(combos):
        return np.zeros(0)
    size = len(have)

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], x, size) for k in range(3)) * (np.arange(size) > 0)

    def back(r: np.ndarray) -> np.ndarray:
        return sum(np.where(combos[:, k] > 0, r[combos[:, k]], 0.0) for k in range(3))

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue gives the step
        w = back(used(v))
        norm = np.linalg.norm(w)
        v = w / norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - back(used(y) - have) / (1.01 * norm))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / t2 * (new - x), t2
    return x


def combined(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence (-1: in none) and offset of each rest, and the number of sequences.

    Repeat counts are solved against the histogram of the rests. They are rounded along the list
    of combinations, each taking over what the one before it lost or won, so that sums of counts
    stay what was solved; then combinations take their rests, the longest first, while there are any.
    """
    have = np.bincount(lengths, minlength=window + 1)
    combos = combinations(have, window)
    upto = np.floor(np.cumsum(solve(combos, have)) + 0.5)
    repeat = np.diff(upto, prepend=0).astype(np.int64)
    by_length, begin = np.argsort(lengths, kind="stable"), np.cumsum(have) - have
    sequence, offset = np.full(len(lengths), -1), np.zeros(len(lengths), np.int64)
    left, count = have.copy(), 0
    for i in np.flatnonzero(repeat)[::-1]:      # combinations are listed by their longest rest
        parts = [int(x) for x in combos[i] if x]
        n = min([int(repeat[i]), *(int(left[x]) // parts.count(x) for x in parts)])
        at = 0
        for x in parts if n > 0 else []:
            first = begin[x] + have[x] - left[x]
            rests = by_length[first:first + n]
            sequence[rests], offset[rests] = count + np.arange(n), at
            left[x] -= n
            at += x
        count += max(n, 0)
    return sequence, offset, count


class Packer:
    """Sequences of the documents of one task, a bounded number of tokens at a time."""

    def __init__(self, window: int):
        self.window, self.tail, self.sequences = window, [], 0
        self.pieces: list[tuple] = []
        self.held = 0

    def add(self, key, ids: bytes) -> None:
        """Take in a document: whole windows, and the rest."""
        n = len(ids) // 4
        self.pieces += [(key, at, n, ids[4 * at:4 * (at + self.window)]) for at in range(0, n, self.window)]
        self.held += n

    def rows(self) -> list[tuple]:
        """(place, offset, combined, piece) of what fills sequences, in their order.

        Rests that no combination takes are laid end to end behind those left over before, and
        cut where a window ends; what does not fill a window waits for the next documents.
        """
        sizes = np.array([len(p[3]) // 4 for p in self.pieces], np.int64)
        full = sizes == self.window
        rests = np.flatnonzero(~full)
        sequence, offset, count = combined(sizes[rests], self.window)
        placed = [(i, 0, False, self.pieces[k]) for i, k in enumerate(np.flatnonzero(full))]
        first = len(placed)
        placed += [(first + int(s), int(o), True, self.pieces[k])
                   for k, s, o in zip(rests, sequence, offset) if s >= 0]
        first, at, tail = first + count, 0, []
        for key, start, n, ids in [*self.tail, *(self.pieces[k] for k in rests[sequence < 0])]:
            while ids:
                cut = min(len(ids) // 4, self.window - at % self.window)
                tail.append((first + at // self.window, at % self.window, False, (key, start, n, ids[:4 * cut])))
                ids, start, at = ids[4 * cut:], start + cut, at + cut
        last = first + at // self.window
        self.tail = [r[3] for r in tail if r[0] == last]
        placed += [r for r in tail if r[0] < last]
        placed.sort(key=lambda r: r[:2])
        done = [(self.sequences + s, o, c, p) for s, o, c, p in placed]
        self.sequences, self.pieces, self.held = self.sequences + last, [], 0
        return done

    def loose(self) -> list[tuple]:
        """What is left at the end: less than a window, its places counted on their own."""
        at = np.cumsum([0, *(len(p[3]) // 4 for p in self.tail)])
        return [(None, int(o), False, p) for o, p in zip(at, self.tail)]


def _pack(path: str, window: int, kind: pa.DataType):
    schema = pa.schema([("key", kind), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("part", pa.int64()),
                        ("local", pa.int64()), ("offset", pa.int64()), ("combined", pa.bool_()),
                        ("ids", pa.binary())])

    def out(part: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*(
                (key, start, len(ids) // 4, zlib.crc32(ids), n, part, local, offset, mixed, ids)
                for local, offset, mixed, (key, start, n, ids) in rows[i:i + BATCH_ROWS])), schema)],
                schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, packer = encoder(path), np.array([END_ID], "<u4").tobytes(), Packer(window)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                packer.add(key.as_py(), encode(text.as_py() or "") + end)
                if packer.held >= CHUNK_TOKENS:
                    yield from out(part, packer.rows())
        yield from out(part, packer.rows() + packer.loose())

    return pack


def packed_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  window: int = WINDOW, ordered: bool = True) -> DataFrame:
    """Pieces with their ids, of which each sequence is made up by offset.

    The columns are key, start, length, ids_crc32, doc_tokens, sequence_id, offset, combined (was
    it placed by a solved combination), ids (little-endian). Each task packs the documents that
    it reads, some million tokens at a time, and writes their pieces in the order of its
    sequences, so ids are written once and not exchanged. A row per task then numbers the
    sequences through and lays the ends of the tasks, less than a window each, end to end:
    only the last sequence of all is not full. ``ordered`` moves the pieces once more, so that
    those of a sequence stand behind each other in one partition of the result.

    A null text is empty and has the end id only; a text of any length is cut into windows;
    repeated rows and null keys are documents of their own; an empty table gives no sequence.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[key].dataType
    pieces = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _pack(path, window, to_arrow_type(kind)), f"key {kind.simpleString()}, start bigint, length bigint, "
        "ids_crc32 bigint, doc_tokens bigint, part bigint, local bigint, offset bigint, combined boolean, "
        "ids binary")
    pieces = write(pieces, "pack-pieces", codec="zstd").df
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    parts = pieces.groupBy("part").agg(
        F.coalesce(F.max("local") + 1, F.lit(0)).alias("full"),
        F.coalesce(F.sum(F.when(F.col("local").isNull(), F.col("length"))), F.lit(0)).alias("loose"))
    parts = write(parts.select("part", upto("full").alias("first"), upto("loose").alias("at"), "full"),
                  "pack-parts")
    known = pieces.join(parts.copied(), "part")
    filled = known.where("local is not null").select(
        "key", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("local")).alias("sequence_id"), "offset", "combined", "ids")
    whole = parts.df.agg(F.coalesce(F.sum("full"), F.lit(0))).scalar()
    place = F.col("at") + F.col("offset")
    room = F.least("length", window - place % window)
    cuts = F.array(F.struct(F.lit(0).cast("bigint").alias("skip"), room.alias("n")),
                   F.struct(room.alias("skip"), (F.col("length") - room).alias("n")))
    loose = known.where("local is null").withColumns({"place": place, "cut": F.explode(cuts)}).where("cut.n > 0")
    loose = loose.withColumn("ids", F.substring("ids", (4 * F.col("cut.skip") + 1).cast("int"),
                                                (4 * F.col("cut.n")).cast("int")))
    loose = loose.withColumn("place", F.col("place") + F.col("cut.skip")).select(
        "key", (F.col("start") + F.col("cut.skip")).alias("start"), F.col("cut.n").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        (whole + F.floor(F.col("place") / window)).alias("sequence_id"),
        (F.col("place") % window).alias("offset"), "combined", "ids")
    rows = filled.unionByName(loose).withColumnRenamed("key", key)
    if not ordered:
        return rows
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(shuffles, "sequence_id").sortWithinPartitions("sequence_id", "offset")
