"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import json
import os
from math import comb, isqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvemill.llm import (html_text, leaks, licenses, lm, neardup, packing, pii, quality,
                           queries, secrets, sharding)

LONG = "word " * 30_000
SCHEMA = ("doc_id bigint, text string, source string, words string, rules int, uid string, "
          "row string, n_words int, leak string, pii string, kept int, n_chars bigint")


@pytest.fixture(scope="module")
def odd(spark):
    same = " ".join(f"w{i}" for i in range(80))
    texts = [None, "", " \t\n", "one", LONG, same, same, same.upper(), "a b c d", "É ü 中文 字"]
    rows = [(i if i != 3 else None, t, None if i % 2 else "h", "x", 1, "u", "r", 2, "l", "p", 3, 4)
            for i, t in enumerate(texts)]
    rows += [rows[5]] * 3  # the same row again, key and all
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, None), (1, ""), (2, "one"), (3, " ".join(
        f"w{i}" for i in range(20, 34))), (10, "w1 w2")], "item_id bigint, text string")


def test_row_by_row_operators(odd, none):
    for scan in (secrets.scan, licenses.scan):
        assert scan(odd).count() == 13 and scan(none).count() == 0
    assert html_text.extract(odd, "doc_id", "text").count() == 13
    done, found = pii.pseudonymise(odd, "k")
    assert found != "pii" and done.select(*odd.columns).exceptAll(odd).count() == 0
    assert pii.pseudonymise(none, "k")[0].count() == 0


def test_quality(odd, none):
    judged, rules = quality.judge(odd)
    assert judged.count() == 13 and set(odd.columns) < set(judged.columns)
    assert judged.where(F.col("text").isNull() & F.col(f"{rules}.kept")).count() == 0
    assert judged.where((F.col("doc_id") == 4) & (F.col(f"{rules}.n_repeat_words") == 30_000)) \
        .count() == 1
    assert quality.judge(none)[0].count() == 0


def test_a_rejected_host_takes_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(400)] + [(1000, good, "bad"), (1001, good, "fine")]
    rows += [(2000 + i, good, "fine") for i in range(400)]
    judged, rules = quality.judge(spark.createDataFrame(rows, "doc_id int, text string, source string"))
    kept = {r.doc_id for r in judged.where(f"{rules}.kept").collect()}
    assert 1001 in kept and 1000 not in kept


def test_near_duplicates(odd, none):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in neardup.link(odd).collect()]
    assert sorted(rows, key=str) == sorted(
        [(0, 0, 0), (1, 0, 1), (2, 0, 2), (None, 1, None), (4, 1, 4), *[(5, 76, 5)] * 4,
         (6, 76, 5), (7, 76, 5), (8, 1, 8), (9, 1, 9)], key=str)
    kept = [r.doc_id for r in neardup.one_of_each(odd).collect()]
    assert sorted(kept, key=str) == sorted([0, 1, 2, None, 4, 5, 8, 9], key=str)
    assert neardup.link(none).count() == 0 and neardup.one_of_each(none).count() == 0


def test_one_of_each_never_drops_by_key_alone(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"]
    data = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (1, texts[2]), (1, texts[3]),
            (1, texts[3]), (2, texts[4]), (None, texts[4]), (3, texts[4].upper()),
            (None, ""), (None, ""), (None, None), (4, texts[5])]
    rows = spark.createDataFrame(data, "doc_id bigint, text string")
    kept = [tuple(r) for r in neardup.one_of_each(rows).collect()]
    assert sorted(kept, key=str) == sorted([
        (None, texts[0]), (None, texts[1]), (1, texts[2]), (1, texts[3]), (2, texts[4]),
        (None, ""), (None, ""), (None, None), (4, texts[5])], key=str)


def test_near_copies_that_meet_only_through_others(spark):
    base = [f"t{i}" for i in range(200)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(0, 200, 9)]
    texts += [" ".join(base[20 * k:] + [f"y{k}_{i}" for i in range(20 * k)]) for k in range(1, 9)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [set(neardup.shingles(t.encode()).tolist()) for t in texts]
    low = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 75 * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    got = {r.doc_id: r.component_id for r in neardup.link(rows).collect()}
    assert [got[i] for i in range(len(texts))] == low


def test_leaks(odd, none, items):
    found, leak = leaks.find(odd, items)
    got = {(r.doc_id, r[leak].n_hit, tuple(r[leak]["items"])) for r in found.collect()}
    assert found.count() == 13 and leak != "leak"
    assert (None, 1, ("2",)) in got and (5, 16, ("10", "3")) in got and (0, 0, ()) in got
    assert leaks.find(none, items)[0].count() == 0
    clean, leak = leaks.find(odd, items.limit(0))
    assert clean.where(F.col(f"{leak}.n_hit") > 0).count() == 0 and clean.count() == 13


@pytest.mark.parametrize("within,missing", [(10, 1), (0, 1), (25, 2)])
def test_near_places_equal_brute_force(spark, within, missing):
    random = np.random.default_rng(within)
    words = [f"w{i}" for i in range(40)]
    items = [" ".join(random.choice(words, n)) for n in (14, 12, 6, 3, 1)]
    items[1] = " ".join(words[20:32])
    texts = [" ".join(random.choice(words, n)) for n in (0, 5, 30, 60, 60)]
    line = words[20:30]
    texts += [" ".join(line[::-1]), " ".join(line[:4] + line[5:]), " ".join(line[:3] + line[6:]),
              " ".join(line[:5] + ["x"] * 10 + line[5:]), " ".join(line[:5] + ["x"] * 11 + line[5:]),
              " ".join(line[:5] + ["x"] * 25 + line[5:])]
    found, leak = leaks.find(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"),
                             spark.createDataFrame(list(enumerate(items)), "item_id int, text string"),
                             within=within, missing=missing)
    got = {r.doc_id: (r[leak].n_near, r[leak].near_items) for r in found.collect()}
    windows = {(i, tuple(x.split()[s:s + 10])) for i, x in enumerate(items)
               for s in range(max(len(x.split()) - 9, 1))}
    for doc, text in enumerate(texts):
        w, near = text.split(), set()
        for item, window in windows:
            terms = set(window)
            need = len(terms) - (missing if len(terms) >= 5 else 0)
            if any(len(terms & set(w[s:s + len(window) + within])) >= need for s in range(len(w))):
                near.add((item, window))
        assert got[doc] == (len({x for _, x in near}), sorted({str(i) for i, _ in near})), doc
    assert got[5][0] > 0  # all words in reverse order


def test_language_model(odd, none):
    rows = lm.score(odd).toPandas()
    assert len(rows) == 13 and np.isfinite(rows.base_score).all() and np.isfinite(rows.score).all()
    assert lm.score(none).count() == 0


def test_packing(odd, none):
    path = queries.tokenizer_path()
    rows = packing.packed_pieces(odd, path).toPandas()
    assert rows.length.sum() == rows[rows.start == 0].doc_tokens.sum()
    assert (rows[rows.start == 0].doc_tokens == 1).sum() == 2
    assert packing.packed_pieces(none, path).count() == 0


def test_packed_ids_make_up_sequences(odd):
    path = queries.tokenizer_path()
    rows = packing.packed_pieces(odd, path, window=64).collect()
    encode, places = packing.encoder(path), {}
    for part in packing.packed_pieces(odd, path, window=64).rdd.glom().collect():
        at = [(r.sequence_id, r.offset) for r in part]
        assert at == sorted(at)
        for i in {s for s, _ in at}:
            assert i not in places
            places[i] = b"".join(r.ids for r in part if r.sequence_id == i)
    sizes = sorted(len(ids) for ids in places.values())
    assert sizes[1:] == [4 * 64] * (len(places) - 1) and 0 < sizes[0] <= 4 * 64
    for text, key in (("a b c d", 8), ("word " * 30_000, 4)):
        ids = b"".join(r.ids for r in sorted(rows, key=lambda r: r.start) if r.doc_id == key)
        assert ids == encode(text) + np.array([packing.END_ID], "<u4").tobytes()


def test_solved_combinations_take_most_rests():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 0.8, 3000).astype(int) + 1, 2047)
    sequence, offset, count = packing.combined(lengths, 2048)
    assert lengths[sequence >= 0].sum() > 0.5 * lengths.sum()
    for s in range(count):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert lengths[own].sum() == 2048
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1]]
    assert packing.combined(np.zeros(0, int), 2048)[2] == 0
    assert packing.combined(np.full(5, 1024), 2048)[2] == 2


def test_packing_in_small_chunks(odd, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 100)
    monkeypatch.setattr(packing, "BATCH_ROWS", 3)
    rows = packing.packed_pieces(odd.repartition(3), queries.tokenizer_path(), window=64).toPandas()
    full = rows.groupby("sequence_id").length.sum()
    assert sorted(full.index) == list(range(len(full))) and (full[:-1] == 64).all() and full.iloc[-1] <= 64
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    assert rows.length.sum() == rows[rows.start == 0].doc_tokens.sum()


def test_ranks_need_merges_in_order(tmp_path):
    given = json.load(open(queries.tokenizer_path()))
    assert len(packing.merge_ranks(queries.tokenizer_path())) == 50_256
    merges = given["model"]["merges"]
    for change in ({"merges": [merges[1], merges[0], *merges[2:]]}, {"ignore_merges": True}, {"dropout": 0.1}):
        path = tmp_path / "changed.json"
        path.write_text(json.dumps({**given, "model": {**given["model"], **change}}))
        assert packing.merge_ranks(str(path)) is None


def test_rare_signs_take_the_whole_tokenizer():
    encode = packing.encoder(queries.tokenizer_path())
    tok = packing.tokenizer(queries.tokenizer_path())[0]
    for text in ("it's 12 o'clock\n\n  now ", "中文 字　x", "a<|endoftext|>b", "\x1c x\x85y", "é\xa0ß ²"):
        assert np.frombuffer(encode(text), "<u4").tolist() == tok.encode(
            text, add_special_tokens=False).ids


def test_sharding(odd, none):
    dealt = sharding.deal(odd, 4)
    assert sorted(r["count"] for r in dealt.groupBy("shard").count().collect()) == [3, 3, 3, 4]
    assert dealt.drop("shard", "slot").exceptAll(odd).count() == 0
    assert sharding.deal(none, 4).count() == 0
    with pytest.raises(ValueError, match="shard or slot"):
        sharding.deal(odd.withColumn("Slot", F.lit(1)), 4)
    clash = odd.withColumns({c: F.lit(1) for c in (
        "_metadata", "path", "path_", "at", "part", "base", "place", "file", "n", "_g", "_cell", "_ends")})
    assert sharding.deal(clash, 4).drop("shard", "slot").exceptAll(clash).count() == 0


def test_permutations_are_one_to_one():
    for n in (1, 2, 3, 5, 24, 1000, 65_537):
        x = np.arange(n)
        got = sharding.permuted(x, np.full(n, n), np.full(n, 12345 + n, np.uint64))
        assert sorted(got) == list(range(n)) and (n < 24 or (got != x).any())
    seen = np.zeros((4, 4))
    for key in sharding.keys_of(3, 1, 20_000):
        seen[np.arange(4), sharding.permuted(np.arange(4), np.full(4, 4), np.full(4, key))] += 1
    assert np.abs(seen / 20_000 - 0.25).max() < 0.02
    large = np.array([0, 1, 2 ** 50 - 1])
    got = sharding.permuted(large, np.full(3, 2 ** 50), np.full(3, 9, np.uint64))
    assert len(set(got)) == 3 and got.min() >= 0 and got.max() < 2 ** 50


def permuted_by_hand(x, n, key):
    mask = 2 ** 64 - 1

    def mixed(number, value):
        h = (key + (number + 1) * 0x9E3779B97F4A7C15 + value * 0xD1B54A32D192ED03) & mask
        h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
        return h ^ h >> 31

    a = max(1, isqrt(n - 1) + 1)
    b = -(-n // a)
    while True:
        high, low = divmod(x, b)
        for i in range(8):
            if i % 2:
                low = (low + mixed(i, high)) % b
            else:
                high = (high + mixed(i, low)) % a
        x = high * b + low
        if x < n:
            return x


def test_deal_by_hand_and_under_any_split(spark, tmp_path):
    """Parts, runs and slots counted out row by row; other splits of the files change nothing."""
    shards, seed, rows = 5, 11, []
    for f, n in enumerate((40, 1, 77, 13)):
        part = [(f * 1000 + i, f"text {i}") for i in range(n)]
        folder = str(tmp_path / f"{f}")
        spark.createDataFrame(part, "id long, text string").coalesce(1).write.parquet(folder)
        rows.append(part)
    read = lambda: spark.read.parquet(*[str(tmp_path / f"{f}") for f in range(4)])
    matrix = sharding.communication_matrix(np.array([40, 1, 77, 13] + [0] * 1020), shards, seed)
    want, filled = {}, [0] * shards
    for f, part in enumerate(rows):
        n, runs = len(part), [s for s in range(shards) for _ in range(matrix[f, s])]
        dealt = {permuted_by_hand(i, n, int(sharding.keys_of(seed, 1, 1024)[f])): row for i, row in enumerate(part)}
        for rank, s in enumerate(runs):
            total, key = int(matrix[:, s].sum()), int(sharding.keys_of(seed, 2, shards)[s])
            want[dealt[rank][0]] = s, permuted_by_hand(filled[s], total, key)
            filled[s] += 1
    got = {r.id: (r.shard, r.slot) for r in sharding.deal(read(), shards, seed).collect()}
    assert got == want
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        assert {r.id: (r.shard, r.slot) for r in sharding.deal(read(), shards, seed).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    some = sharding.deal(read().where("id % 2 = 0"), shards, seed).groupBy("shard").count().collect()
    assert max(r["count"] for r in some) - min(r["count"] for r in some) <= 1


def test_matrix_has_exact_margins():
    rows = np.array([5, 0, 17, 1, 100])
    matrix = sharding.communication_matrix(rows, 7, 3)
    assert matrix.sum(axis=1).tolist() == rows.tolist() and np.ptp(matrix.sum(axis=0)) <= 1


def test_matrix_keeps_its_law_above_the_sampler(monkeypatch):
    rows = np.array([1_200_000_000, 3, 700_000_001])
    matrix = sharding.communication_matrix(rows, 5, 3)
    assert matrix.sum(axis=1).tolist() == rows.tolist() and np.ptp(matrix.sum(axis=0)) <= 1
    assert np.ptp(sharding.communication_matrix(np.array([600_000_000] * 2), 2, 3)[0]) > 0
    monkeypatch.setattr(sharding, "LIMIT", 0)
    random = np.random.default_rng(1)
    for good, bad, sample in ((6, 9, 5), (3, 20, 12), (1, 1, 1), (4, 0, 3), (0, 4, 3), (5, 5, 10)):
        got = np.bincount([sharding.drawn(random, good, bad, sample) for _ in range(20_000)],
                          minlength=sample + 1) / 20_000
        want = [comb(good, k) * comb(bad, sample - k) / comb(good + bad, sample)
                for k in range(sample + 1)]
        assert np.abs(got - want).max() < 0.02


def test_shards_hold_whole_documents(spark, monkeypatch):
    dealt = []
    deal = sharding.deal
    monkeypatch.setattr(sharding, "deal", lambda df, n: dealt.append(deal(df, n)) or dealt[0])
    folder = "/root/testdata/sf0.001"
    queries.op6_hypergeometric_shards(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert dealt[0].columns == [*docs.columns, "shard", "slot"]
    assert dealt[0].drop("shard", "slot").exceptAll(docs).count() == 0


def test_secrets_follow_constants():
    key = "k3J9x_Qp72LmZ0aB"
    text = f'BASE = "{key}"\ndb_password = BASE\nuser_name = "{key}x"\napiToken: "changeme-please"'
    spans = secrets.scored_spans(text)
    assert [(text[a:b], kind) for a, b, kind, _ in spans] == [(key, "constant")]


def test_secrets_follow_sums_of_any_length():
    keys = [f"k3J9x_Qp72LmZ0a{i:03}" for i in range(3000)]
    lines = "\n".join(f'k = k + "{key}"' for key in keys[1:])
    spans = secrets.scored_spans(f'k = "{keys[0]}"\n{lines}\npassword = k\nsecret = k')
    assert len(spans) == 3000 and {kind for _, _, kind, _ in spans} == {"constant"}
    text = "a = " + " + ".join(f'"{key}"' for key in keys[:20]) + "\ndb_password = a + a"
    assert sorted(text[a:b] for a, b, _, _ in secrets.scored_spans(text)) == keys[:20]
    more = "\n".join(f'password = password + "{key}"' for key in keys)
    assert sorted(more[a:b] for a, b, _, _ in secrets.scored_spans(more) if b - a >= 18) == sorted(keys)
    twice = "\n".join(f"a{i + 1} = a{i} + a{i}" for i in range(200))
    assert len(secrets.scored_spans(f'a0 = "{keys[0]}"\n{twice}\ntoken = a200')) == 1


def test_valid_values_stay_valid(spark):
    values = ["4111 1111 1111 1111", "078-05-1120", "1999-12-31", "(949) 555-0243",
              "GB82 WEST 1234 5698 7654 32", "10.0.0.255", "4111 1111 1111 1112", "2001-02-30"]
    rows = spark.createDataFrame([(i, f"x {v}, {v}") for i, v in enumerate(values)],
                                 "doc_id int, text string")
    done, found = pii.pseudonymise(rows, "k")
    got = {r.doc_id: r for r in done.collect()}
    for i, v in enumerate(values[:6]):
        one, two = got[i].text[2:].split(", ")
        assert one == two != v and len(got[i][found]) == 2, v
    assert got[6].text == f"x {values[6]}, {values[6]}" and got[7].text == f"x {values[7]}, {values[7]}"
    again, more = pii.pseudonymise(done.select("doc_id", "text"), "k")
    assert again.where(F.size(more) > 0).count() == 6  # a pseudonym is a valid value itself


def test_dates_of_two_centuries_are_permuted(spark):
    days = spark.sql("select cast(date_add(date '1900-01-01', cast(id as int)) as string) as text, id "
                     "as doc_id from range(73049)")
    done, found = pii.pseudonymise(days, "k")
    new = done.where(F.size(found) == 1).select("text").distinct()
    assert new.count() == 73049 and days.select("text").exceptAll(new).count() == 0


def test_page_layout():
    page = ("<title>no</title><p>One<p>two <b>bold</b><br>line<ul><li>a<li>b<ol start=3><li>c</ol></ul>"
            "<table><tr><th>Name<th>N<tr><td>x<td>10</table><div style='display:none'>no</div>"
            "<pre>  a\n b</pre><script>no</script>&amp; end")
    assert html_text.page_text(page) == (
        "One\n\ntwo bold\nline\n\n- a\n- b\n  3. c\n\nName  N\nx     10\n\n  a\n b\n\n& end")
    assert html_text.page_text("<div>" * 3000 + "deep") == "deep"
    assert html_text.page_text(None) == ""


def test_text_of_rows_drawings_and_fields():
    assert html_text.page_text("<table><tr>note<td>a</td> more<td>b</tr></table>") == (
        "note\nmore\na  b")
    page = ("<p>x <math><mi>y</mi><annotation>no</annotation></math><svg><title/><desc>no</desc>"
            "<path/><text>z</text></svg><p><select><option>one<option>two</select>"
            "<textarea>three</textarea><p><svg/>end")
    assert html_text.page_text(page).split() == ["x", "yz", "one", "two", "three", "end"]
    assert "no" not in html_text.page_text(page)


def test_quality_with_clashing_helpers(odd):
    names = ("_host", "_rate", "_rejected", "judged_host", "rate", "rejected", "windows", "host")
    clash = odd.withColumns({c: F.lit("x") for c in names})
    judged, rules = quality.judge(clash)
    assert judged.drop(rules).exceptAll(clash).count() == 0 and judged.count() == clash.count()


def test_pipeline_end_to_end_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows, clashing names and an empty table through all five stages."""
    import corpus_pipeline

    good = [f"alpha{i % 7} beta{i} gamma{i % 5} delta{i * 3}" for i in range(40)]
    text = "\n".join(good)
    rows = [(1, text, "en", "h", 9), (2, text, "en", "h", 9), (2, text, "en", "h", 9), (None, text + " x", "en", None, 9),
            (3, None, None, "h", None), (4, "", "en", "h", 0), (5, "short", "en", "h", 5),
            (6, " ".join(f"other{i} mail{i}@mail1.example.com" for i in range(60)), "fr", "g", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, data in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(data, schema).withColumn("rate", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "no such item text at all")], "item_id bigint, text string") \
            .write.parquet(f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        kept = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in kept} <= {1, 2, None, 6}
        assert len({r.doc_id for r in kept}) == (2 if data else 0) and (not data or 6 in {r.doc_id for r in kept})
        for _, stage in corpus_pipeline.STAGES[:-1]:     # without writing in between
            docs = stage(spark, docs, folder)
            docs.count()
            assert docs.columns == [*schema.replace(" bigint", "").replace(" string", "").split(", "), "rate"]


def test_stages_remove_what_the_one_before_left(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    left = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        kept.write.parquet(f"{tmp_path}/{i}")
        assert not [p for p in left if os.path.exists(p)]
        left = corpus_pipeline._left[spark.sparkContext.applicationId]
        assert left and all(os.path.exists(p) for p in left)
        docs = spark.read.parquet(f"{tmp_path}/{i}")
