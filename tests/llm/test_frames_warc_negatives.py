"""op11 to op13 on hand-made rows: brute force, broken archives and edge cases."""

import base64
import hashlib
import math
import re
import struct
import uuid

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curvemill.llm import frames, negatives, warc

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def by_hand(text, key, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\t\n  😀<PSM>", max_size=60), st.integers(0, 10 ** 6),
       st.integers(1, 40))
def test_frames_of_one_text(text, key, size):
    stored = frames.frames_of(text.encode(), zstandard.ZstdCompressor(), size)
    assert stored["units"] == len(UNIT.findall(text)) and stored["chars"] == len(text)
    done = frames.rearranged(stored, key, 42, (50, 80), zstandard.ZstdDecompressor())
    n, form, prefix, middle, output = by_hand(text, key)
    assert (done["n"], done["form"], done["prefix_chars"], done["middle_chars"]) == (
        n, form, prefix, middle)
    assert done["output"].decode() == output
    assert done["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
    assert done["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_only_frames_with_a_cut_are_opened_for_the_cuts():
    text = " ".join(f"word{i}" for i in range(5000)).encode()
    stored = frames.frames_of(text, zstandard.ZstdCompressor(), 1000)
    assert len(stored["frames"]) > 30
    reader = frames.Reader(stored, zstandard.ZstdDecompressor())
    for cut in (0, 1, 777, 2500, 5000):
        assert reader.cut(cut)[0] == len(b"".join(UNIT.findall(text.decode())[i].encode()
                                                  for i in range(cut)))
    assert len(reader.held) <= 3


def test_fim_edges(spark):
    long = "x y\n" * 200_000
    data = [(i, t, "s") for i, t in enumerate(
        ["a b c", None, "", " \t\n", "has <P> in it", long, "äö 😀 ü", "x" * 300_000, "a b c", "a<S b"] * 6)]
    data += [(None, "no key here", None), (None, "no key here", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, stored string").withColumn(
        "fim", F.lit(1))
    stored, name = frames.store(docs, frame_bytes=1000)
    done, fim = frames.transform(stored, name, "doc_id")
    assert {"stored", "fim", "doc_id"} < set(done.columns) and name != "stored" and fim != "fim"
    rows = done.select("doc_id", "stored", f"{fim}.*", frames.restore(
        F.col(f"{fim}.output"), F.col(f"{fim}.form")).alias("restored")).collect()
    want = sorted((repr((k, s, *by_hand(t, k), t or "")) for k, t, s in data))
    assert sorted(repr((r.doc_id, r["stored"], r.n, r.form, r.prefix_chars, r.middle_chars, r.output,
                        r.restored)) for r in rows) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    empty = frames.transform(frames.store(docs.limit(0))[0], name, "doc_id")[0]
    assert empty.count() == 0


def pages_of(spark, data, parts=2):
    return spark.createDataFrame(data, "page_id long, url string, html string").withColumns(
        {"place": F.lit("clash"), "payload": F.lit(0), "same": F.lit(1)}).repartition(parts)


def folder_of(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


def test_archives_hold_every_page(spark, tmp_path):
    texts = [f"<p>page {i % 700} {'x' * (i % 50)}" for i in range(3000)]
    data = [(i * 3, f"http://h/{i}", t) for i, t in enumerate(texts)]
    data += [(9001, None, None), (9002, "u", ""), (None, "u", ""), (7, "a b\r\nX: yé%", "<b>\r\n\r\n"),
             (7, "twice", "<b>\r\n\r\n"), (9004, "long", "z" * 3_000_000), (None, None, "alone")]
    folder = folder_of(tmp_path)
    warc.write_archives(pages_of(spark, data), folder)
    rows = warc.read_archives(spark, folder).collect()
    assert len(rows) == len(data) and not [r for r in rows if r.error]
    first = {}
    for key, _, html in sorted(data, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(html or "", key)
    left = {}
    for r in rows:
        left.setdefault((r.key, r.payload_digest), []).append(r)
    responses = 0
    for key, url, html in data:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        r = left[(None if key is None else str(key), digest)].pop()
        assert r.payload_bytes == len(raw)
        if r.record_type == "response":
            responses += 1
            assert bytes(r.payload) == raw and first[html or ""] == key and r.refers_to is None
        else:
            assert r.record_type == "revisit" and r.payload is None
            assert r.refers_to == (None if first[html or ""] is None else str(first[html or ""]))
    assert responses == len(first)
    assert {r.target for r in rows} >= {"about:blank", "a%20b%0D%0AX:%20y%C3%A9%25"}


def test_archives_are_plain_zstandard_files(spark, tmp_path):
    folder = folder_of(tmp_path)
    warc.write_archives(pages_of(spark, [(i, "u", f"<p>{i} {'text ' * 30}") for i in range(500)], 1), folder)
    files = spark.read.format("binaryFile").load(folder).collect()
    assert len(files) == 1
    data = bytes(files[0].content)
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_FRAME
    unpacker = zstandard.ZstdDecompressor(dict_data=warc.leading_dictionary(memoryview(data)))
    whole = unpacker.stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 500


def test_empty_table_gives_no_record(spark, tmp_path):
    folder = folder_of(tmp_path)
    warc.write_archives(pages_of(spark, []), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_other_archives_and_broken_ones():
    good = warc.record_of(1, "5", "u", b"<p>", 1, None, "2024-01-01T00:00:00Z")
    pack = zstandard.ZstdCompressor().compress
    read = lambda data: [r.get("error") for r in warc.records_of(data)]
    assert read(b"") == [] and read(pack(good) * 3) == [None] * 3
    trained = warc.dictionary_of([good + str(i).encode() * 50 for i in range(400)])
    with_dictionary = zstandard.ZstdCompressor(dict_data=trained).compress(good)
    raw = trained.as_bytes()
    for content in (raw, pack(raw)):
        lead = struct.pack("<II", warc.DICTIONARY_FRAME, len(content)) + content
        assert read(lead + with_dictionary + pack(good)) == [None, None]
    assert read(struct.pack("<II", warc.DICTIONARY_FRAME, 3) + b"abc" + pack(good))[0]
    streamed = zstandard.ZstdCompressor(write_content_size=False, write_checksum=True).compressobj()
    assert read(streamed.compress(good) + streamed.flush()) == [None]
    for bad in (good[:-1], good + b"x", good.replace(b"Content-Length: 3", b"Content-Length: 4"),
                good.replace(b"<p>", b"<q>"), good.replace(b"WARC/1.1", b"WARC/9"),
                good.replace(b"WARC-Date", b"WARC-Day"), good.replace(b"WARC-Type: ", b"WARC-Type "),
                good.replace(b"Payload-Length: 3", b"WARC-Date: x"), b"", b"\xff" * 40,
                re.sub(rb"\r\nContent-Length: \d+\r\n\r\nHTTP", b"\r\nContent-Length: \xc2\xb2\r\n\r\nHTTP", good)):
        errors = read(pack(good) + pack(bad) + pack(good))
        assert errors[0] is None and errors[1] and errors[2] is None
    frame = pack(good)
    for cut in range(1, len(frame)):
        assert read(frame + frame[:cut])[0] is None and read(frame + frame[:cut])[-1]
    assert read(frame + b"garbage!" + frame)[1]
    harmed = bytearray(zstandard.ZstdCompressor(write_checksum=True).compress(good))
    harmed[-1] ^= 1
    assert read(bytes(harmed) + frame)[0] and read(bytes(harmed) + frame)[1] is None


def mined_by_hand(data, shift=True, scale=256):
    rows = []
    for uid, (key, vector, label) in enumerate(data):
        if label is None or vector is None or any(x is None or not math.isfinite(x * scale) for x in vector):
            continue
        if shift and key is not None and key % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        rows.append((uid, key, [math.floor(np.float64(scale) * x) for x in vector], label))
    out = []
    for uid, key, q, label in rows:
        if key is None or key % 50:
            continue
        ranked = sorted(((max(min(sum(x * y for x, y in zip(q, p)), 2 ** 63 - 1), -2 ** 63 + 1), k, o, u)
                         for u, k, p, o in rows if u != uid and len(p) == len(q)),
                        key=lambda r: (-r[0], r[1] is None, r[1], r[3]))
        for score, other, *_ in [r for r in ranked if r[2] == label][:5]:
            found = [r for r in ranked if r[2] != label and 50 * score <= 100 * r[0] and 100 * r[0] <= 95 * score]
            out += [(key, other, i + 1, r[1], score, r[0]) for i, r in enumerate(found[:3])]
    return sorted(out, key=repr)


def mined(spark, data, parts=3):
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumns(
        {"uid": F.lit("clash"), "block": F.lit(1), "dim": F.lit(2)}).repartition(parts)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(rows, label=shifted, anchors=F.col("vec_id") % 50 == 0, scale=256.0)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(4096, 2048, 256), (40, 5, 2)])
def test_negatives_equal_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("ROWS", "ANCHORS", "TILE"), sizes):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    data = [(i * 5, [float(x) for x in np.round(centres[i % 6] + rng.normal(size=24) * 0.6, 1)], int(i % 4) - 1)
            for i in range(400)]
    data += [(50, data[10][1], 1), (50, data[10][1], 1), (None, data[20][1], 2), (None, data[20][1], 2)]
    data += [(3000 + i, [1.0, 2.0], i % 2) for i in range(60)] + [(4000, [], 1), (4001, [], 1), (4002, [], 2)]
    data += [(5000, None, 1), (5050, [1.0, None], 1), (5100, [float("nan")] * 24, 1),
             (5150, [float("inf")] * 24, 1), (5200, data[0][1], None), (5250, [1e308] * 24, 1)]
    got = mined(spark, data)
    assert got == mined_by_hand(data) and len(got) > 60


def test_scores_of_any_size(spark):
    rng = np.random.default_rng(4)
    data = [(i * 25, [float(x) * 10.0 ** int(rng.integers(0, 7) * 2) for x in rng.normal(size=8)], int(i % 3))
            for i in range(80)]
    data += [(2050, [1e150, -1e150], 1), (2100, [1e150, 1e150], 1), (2101, [1e160, 1.0], 2)]
    assert mined(spark, data) == mined_by_hand(data)


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(5)
    for dim in (1, 3, 16, 50):
        a, b = (np.floor(rng.normal(size=(30, dim)) * 100) for _ in range(2))
        (am, ad), (bm, bd) = negatives.summaries(a), negatives.summaries(b)
        at, exact, last = 0, a @ b.T, None
        for starts in negatives.segments(dim):
            sizes, part = np.diff(np.append(starts, dim)), slice(at, at + len(starts))
            middle, spread = (am[:, part] * sizes) @ bm[:, part].T, (ad[:, part] * sizes) @ bd[:, part].T
            assert (middle + spread >= exact - 1e-6).all() and (middle - spread <= exact + 1e-6).all()
            assert last is None or spread.mean() <= last
            at, last = at + len(starts), spread.mean()


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1), (3, [0.9], 2)]) == []
