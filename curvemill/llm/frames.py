"""Fill-in-middle over seekable compressed frames.

``store`` cuts a text into consecutive pieces of whole units, compresses each piece as a
zstandard frame of its own and keeps, per frame, the units, code points and bytes before it.
``transform`` finds the frames that hold the two cuts by those counts, decompresses these for
the places of the cuts, and then streams the frames in order into the output and its digests.
A unit is a run of signs with the blanks before it; blanks at the end are a unit as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvemill.llm.common import fresh

FRAME_BYTES = 65_536        # a frame ends with the unit that reaches this size
BATCH_BYTES = 8_000_000     # of results that a task holds before it passes them on
LEVEL = 3
MARKS = (b"<P>", b"<S>", b"<M>")    # fixed: in front of prefix, suffix and middle

FRAME = "struct<units:bigint,chars:bigint,bytes:bigint,data:binary>"
STORED = (f"struct<frames:array<{FRAME}>,units:bigint,chars:bigint,bytes:bigint,marked:boolean>")
DONE = ("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:binary,"
        "output_sha256:string,text_sha256:string>")


def ends_of_units(text: np.ndarray) -> np.ndarray:
    """Byte offset behind each unit: a unit ends where a blank follows a sign, or the text ends."""
    if not len(text):
        return np.zeros(0, np.int64)
    blank = (text == 32) | ((text >= 9) & (text <= 13))
    return np.append(np.flatnonzero(~blank[:-1] & blank[1:]) + 1, len(text))


def code_points(text: np.ndarray) -> int:
    """Bytes of UTF-8 that begin a code point."""
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def frames_of(text: bytes, packer: zstandard.ZstdCompressor, frame_bytes: int) -> dict:
    """The stored form of one text; each frame carries the counts of what lies before it."""
    raw = np.frombuffer(text, np.uint8)
    ends = ends_of_units(raw)
    frames, unit, at, chars = [], 0, 0, 0
    while unit < len(ends):
        last = min(int(np.searchsorted(ends, at + frame_bytes)), len(ends) - 1)
        end = int(ends[last])
        frames.append({"units": unit, "chars": chars, "bytes": at,
                       "data": packer.compress(text[at:end])})
        chars += code_points(raw[at:end])
        unit, at = last + 1, end
    return {"frames": frames, "units": unit, "chars": chars, "bytes": at,
            "marked": any(m in text for m in MARKS)}


class Reader:
    """One stored text: places of cuts, and its bytes as a stream of frames in order."""

    def __init__(self, stored: dict, unpacker: zstandard.ZstdDecompressor):
        self.frames, self.stored, self.unpacker = stored["frames"], stored, unpacker
        self.starts = {k: np.array([f[k] for f in self.frames] + [stored[k]])
                       for k in ("units", "bytes")}
        self.held: dict[int, bytes] = {}

    def frame(self, i: int) -> bytes:
        return self.held[i] if i in self.held else self.unpacker.decompress(self.frames[i]["data"])

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the cut behind so many units.

        Only the frame that holds the cut is decompressed; it is kept for the stream.
        """
        if units == self.stored["units"]:
            return self.stored["bytes"], self.stored["chars"]
        i = int(np.searchsorted(self.starts["units"], units, "right")) - 1
        begin, inside = self.frames[i], units - self.frames[i]["units"]
        if not inside:
            return begin["bytes"], begin["chars"]
        self.held[i] = self.frame(i)
        raw = np.frombuffer(self.held[i], np.uint8)
        end = int(ends_of_units(raw)[inside - 1])
        return begin["bytes"] + end, begin["chars"] + code_points(raw[:end])

    def stream(self, begin: int, end: int) -> Iterator[bytes]:
        """The bytes from ``begin`` to ``end``, frame after frame."""
        i = int(np.searchsorted(self.starts["bytes"], begin, "right")) - 1
        while begin < end:
            first, behind = int(self.starts["bytes"][i]), int(self.starts["bytes"][i + 1])
            yield self.frame(i)[begin - first:min(end, behind) - first]
            begin, i = behind, i + 1


def choices(key, seed: int) -> list[int]:
    """Four numbers from 0 to 2^32 - 1 that follow from the key alone; a null has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def rearranged(stored: dict, key, seed: int, percent: tuple[int, int],
               unpacker: zstandard.ZstdDecompressor) -> dict:
    """Form, lengths, output and digests of one document."""
    reader, n, size = Reader(stored, unpacker), stored["units"], stored["bytes"]
    one, two, kind, order = choices(key, seed)
    a, b = sorted((one % (n + 1), two % (n + 1)))
    if not size or stored["marked"] or kind % 100 >= percent[0]:
        parts, form, lengths = [(b"", 0, size)], "plain", (None, None)
    else:
        (cut, before), (behind, upto) = reader.cut(a), reader.cut(b)
        prefix, middle = (MARKS[0], 0, cut), (MARKS[2], cut, behind)
        suffix, form = (MARKS[1], behind, size), "spm" if order % 100 < percent[1] else "psm"
        parts = [suffix, prefix, middle] if form == "spm" else [prefix, suffix, middle]
        lengths = before, upto - before
    output, digest, source = [], hashlib.sha256(), hashlib.sha256()
    for mark, begin, end in parts:
        for chunk in chain([mark], reader.stream(begin, end)):
            output.append(chunk)
            digest.update(chunk)
    for chunk in reader.stream(0, size):
        source.update(chunk)
    return {"n": n, "form": form, "prefix_chars": lengths[0], "middle_chars": lengths[1],
            "output": b"".join(output), "output_sha256": digest.hexdigest(),
            "text_sha256": source.hexdigest()}


def _per_row(kept: list[str], name: str, kind: pa.DataType, make, size):
    """A task that puts ``name`` in the place of the last column, in batches of bounded size."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_one = make()
        for batch in batches:
            begin, held, done = 0, 0, []
            for i in range(batch.num_rows):
                done.append(make_one(batch, i))
                held += size(done[-1])
                if held >= BATCH_BYTES or i == batch.num_rows - 1:
                    rows = batch.slice(begin, len(done))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(c) for c in kept] + [pa.array(done, kind)], [*kept, name])
                    begin, held, done = i + 1, 0, []
    return task


def _arrow(ddl: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(T.DataType.fromDDL(ddl))


def _positions(df: DataFrame) -> DataFrame:
    """Columns under their places as names, so that no name can clash in a task."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def store(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
          frame_bytes: int = FRAME_BYTES) -> tuple[DataFrame, str]:
    """The kept columns (all but the text) with the stored text, and the name of that column.

    A null text is stored like an empty one: no frames, no units. A text of any length is kept
    whole, one frame per ``frame_bytes``; a unit longer than that has a frame of its own size.
    Repeated rows stay repeated, an empty table gives an empty one, and the new column gets a
    name that no kept column has.
    """
    names = [c for c in docs.columns if c != text] if keep is None else keep
    name = fresh(docs.select(*names), "stored")
    rows = _positions(docs.select(*names, F.coalesce(F.col(text).cast("binary"), F.lit(b""))))
    kept = rows.columns[:-1]

    def make():
        packer = zstandard.ZstdCompressor(level=LEVEL)
        return lambda batch, i: frames_of(batch.column(len(kept))[i].as_py(), packer, frame_bytes)

    task = _per_row(kept, "done", _arrow(STORED), make,
                    lambda x: sum(len(f["data"]) for f in x["frames"]) + 100)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("done", T.DataType.fromDDL(STORED))])
    return rows.mapInArrow(task, schema).toDF(*names, name), name


def transform(stored: DataFrame, name: str, key: str, seed: int = 42, fim_percent: int = 50,
              spm_percent: int = 80) -> tuple[DataFrame, str]:
    """The rows with the rearranged text instead of the stored one, and that column's name.

    The column holds n (units), form (plain, psm or spm), prefix_chars and middle_chars (code
    points; null if plain), the output and its digest, and the digest of the stored text. Cuts
    and form follow from ``seed`` and the key alone, so equal keys get equal choices in any
    order and on any machine. A null key counts as one without digits. A text that is empty or
    holds one of the marks stays plain.
    """
    names = [c for c in stored.columns if c != name]
    new = fresh(stored.select(*names), "fim")
    rows = _positions(stored.select(*names, name))
    kept, at = rows.columns[:-1], names.index(key)
    percent = fim_percent, spm_percent

    def make():
        unpacker = zstandard.ZstdDecompressor()
        return lambda batch, i: rearranged(batch.column(len(kept))[i].as_py(),
                                           batch.column(at)[i].as_py(), seed, percent, unpacker)

    task = _per_row(kept, "done", _arrow(DONE), make, lambda x: len(x["output"]) + 200)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("done", T.DataType.fromDDL(DONE))])
    done = rows.mapInArrow(task, schema).toDF(*names, new)
    return done.withColumn(new, F.col(new).withField(
        "output", F.col(new)["output"].cast("string"))), new


def restore(output: Column, form: Column) -> Column:
    """The text that was rearranged. The marks occur only where ``transform`` has put them."""
    parts = F.split(output, "<[PSM]>")
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
