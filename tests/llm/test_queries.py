"""Queries over the whole smallest tables against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from curvemill.llm import licenses, lm, pii, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select * from '{FOLDER}/documents.parquet'").df()


def result(spark, name):
    return queries.QUERIES[name](spark, FOLDER).toPandas()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, FOLDER)
    assert got.columns == want.columns
    got, want = ([tuple(r) for r in rows] for rows in (got.collect(), want.fetchall()))
    assert sorted(got, key=repr) == sorted(want, key=repr) and want


def test_secret_scan(spark):
    larger = "/root/testdata/sf0.01"  # the smallest tables have no secret
    docs = duckdb.sql(f"select doc_id, text from '{larger}/documents.parquet'").df()
    got = queries.op2_secret_scan(spark, larger).toPandas().set_index("doc_id")
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|"""
                        r"""(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|"""
                        r"""(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""")
    total = 0
    for doc, text in zip(docs.doc_id, docs.text):
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text)
                  if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text)
                  if len(m[0]) >= 24]
        kinds = Counter(k for _, k, _ in spans)
        row = got.loc[doc]
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds[0], kinds[1], kinds[2])
        text = ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(row.spans.split(","))
        total += len(spans)
    assert total > 0


def test_pseudonyms_keep_format_and_links(spark, docs):
    done, found = pii.pseudonymise(spark.read.parquet(f"{FOLDER}/documents.parquet"), "k")
    rows = done.select("doc_id", "text", found).toPandas().set_index("doc_id")
    seen = {}
    for doc, text in zip(docs.doc_id, docs.text):
        row = rows.loc[doc]
        if not len(row[found]):
            assert row.text == text
        for s in row[found]:
            assert s["old"] in text and s["new"] in row.text and s["old"] != s["new"]
            assert re.sub("[0-9]", "0", s["old"]) == re.sub("[0-9]", "0", s["new"]) \
                or s["kind"] in ("email", "ip")
            assert seen.setdefault(s["old"], s["new"]) == s["new"]
    assert len(set(seen.values())) == len(seen) > 10
    mails = re.compile(r"[\w.]+@mail\d\.example\.com")
    left = {m for t in rows.text for m in mails.findall(t)}
    assert not left & {m for t in docs.text for m in mails.findall(t)}


def test_base_and_class_scores(spark, docs, monkeypatch):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t))
    train = [zlib.crc32(str(d).encode()) % 7 != 2 for d in docs.doc_id]
    count = Counter()
    for text, use in zip(docs.text, train):
        if use:
            count.update([*words(text), None])
    n, v = sum(count.values()), len(count)
    monkeypatch.setattr(lm, "NEAR_WORDS", 3000)     # far words beside each other
    got = result(spark, "op4_class_lm").set_index("doc_id")
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known, _ = lm.train(table)
    assert (known.tokens, known.distinct) == (n, v)
    assert all(count[w.decode()] == k for w, k in known.near)
    of = {w.decode(): c for (w, _), c in zip(known.near, known.of)}
    rest = {bytes(r.word).decode(): (r.n, r.c) for r in known.others.collect()}
    assert all(count[w] == k for w, (k, _) in rest.items())
    of.update({w: c for w, (_, c) in rest.items()})
    assert set(of) == set(count) - {None}           # a class for every training word
    of[None] = lm.STOP
    bigrams = np.zeros((lm.STATES, lm.STATES))
    for text, use in zip(docs.text, train):
        line = [None, *words(text), None]
        for x, y in zip(line, line[1:]) if use else ():
            bigrams[of[x], of[y]] += 1
    assert bigrams[:lm.CLASSES, lm.OPEN].sum() == 0
    step, sizes = np.log10((bigrams + 1) / (bigrams.sum(1, keepdims=True) + lm.STATES)), bigrams.sum(0)
    for doc, text, use in zip(docs.doc_id, docs.text, train):
        row, line = got.loc[doc], [*words(text), None]
        assert row.held_out == (not use) and row.n_tokens == len(line)
        assert row.n_known == sum(count[w] > 0 for w in line) and row.train_tokens == n
        assert np.isclose(row.base_score, sum(np.log10((count[w] + 1) / (n + v + 1))
                                              for w in line))
        total, last = 0.0, lm.STOP
        for w in line:
            now = of.get(w, lm.OPEN)
            total += step[last, now] + (np.log10(count[w] / sizes[now]) if now < lm.OPEN else 0)
            last = now
        assert np.isclose(row.score, total, rtol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()     # texts that were not learned from


def test_best_class_equals_moving_the_word():
    rng = np.random.default_rng(3)
    table = rng.integers(0, 50, (lm.STATES, lm.STATES)).astype(float)
    words = rng.integers(1, 4, 40)
    left, right = (np.zeros((40, lm.STATES)) for _ in "lr")
    for i, n in enumerate(words):
        for side in (left, right):
            np.add.at(side[i], rng.integers(0, lm.STATES, n * 5), 1)
    for i in range(40):
        whole = table.copy()        # the word lies in the open class
        whole[lm.OPEN] += right[i]
        whole[:, lm.OPEN] += left[i]
        scores = []
        for c in range(lm.CLASSES):
            moved = table.copy()
            moved[c] += right[i]
            moved[:, c] += left[i]
            scores.append(lm._likelihood(moved))
        got = lm.best_classes(whole, left[i:i + 1], right[i:i + 1])[0]
        assert np.isclose(scores[got], max(scores), rtol=0, atol=1e-6)


def test_clustering_raises_the_likelihood(spark):
    rows = spark.createDataFrame([(i, "a b c d " * 6 if i % 2 else "a x c y " * 6)
                                  for i in range(60)], "doc_id bigint, text string")
    table = lm.bigram_table(lm.bigrams(*lm.train(rows)).withColumn("held_out", F.lit(False)))
    assert table.sum() == 60 * 25
    flat = np.add.outer(np.zeros(lm.STATES), table.sum(0)) * table.sum(1)[:, None]
    assert lm._likelihood(table) > lm._likelihood(flat / table.sum())


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    got = result(spark, "op5_nnls_packing")
    pieces = {d: g.sort_values("start") for d, g in got.groupby("doc_id")}
    for doc, text in zip(docs.doc_id, docs.text):
        ids, at = [*tok.encode(text, add_special_tokens=False).ids, 1], 0
        for p in pieces[doc].itertuples():
            part = np.array(ids[p.start:p.start + p.length], "<u4")
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            at += p.length
        assert at == len(ids)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
    full = got.groupby("sequence_id").length.sum()
    assert (full < 2048).sum() <= 1
    assert sorted(full.index) == list(range(len(full)))


def test_sharding(spark, docs):
    got = result(spark, "op6_hypergeometric_shards")
    sizes = got.groupby("shard").size()
    assert sorted(sizes.index) == list(range(24)) and sizes.max() - sizes.min() <= 1
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    want = {(d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in zip(docs.doc_id, docs.text)}
    assert set(zip(got.doc_id, got["size"], got.text_crc32)) == want and len(got) == len(docs)


def test_license_scan(spark, docs):
    got = result(spark, "op7_license_scan").set_index("doc_id")
    templates = {label: [x.decode() for x in licenses.words_of(t.encode())]
                 for label, t in licenses.TEMPLATES.items()}
    marks = {"cc-by-nc-4.0": {"nc"}, "cc-by-sa-4.0": {"sa"}}
    named = 0
    for doc, text in zip(docs.doc_id, docs.text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text))
        places = [(i, label) for phrase, label in licenses.PHRASES.items()
                  for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        row = got.loc[doc]
        assert row.n_words == len(w) and row.n_base == len(places)
        if places:
            assert (row.first_word, row.last_word) == (min(places)[0], max(places)[0])
        base = {label for _, label in places}
        assert row.base_labels == ",".join(sorted(base))
        for label, t in templates.items():
            need = np.ceil(licenses.THRESHOLD * len(set(t)) - 1e-9)
            runs = (set(w[at:at + len(t)]) & set(t) for at in range(len(w)))
            base |= {label for run in runs if len(run) >= need and marks.get(label, set()) <= run}
        assert row.labels == ",".join(sorted(base))
        named += bool(base)
    assert named > 0


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY 4.0", set()),
    ("Licensed under CC BY-SA 4.0", {"cc-by-sa-4.0"}),
    ("see: licensed under the CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("apache helicopters carry version two of a drug licensed under rule 2 by the 0 board", set()),
    ("Licensed under the Apache License (Version 2.0)", {"apache-2.0"}),
    ("x " * 997 + "Licensed under the Apache License, Version 2.0", {"apache-2.0"}),
    ("", set())])
def test_license_runs(text, labels):
    index = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    found = {label for block in index.blocks(licenses.words_of(text.encode()))
             for label in index.matches(sorted({t for _, t in block})) if index.run(label, block)}
    assert found == labels


def test_pipeline_keeps_and_drops(spark, docs):
    import corpus_pipeline

    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, table, FOLDER)
    assert good.columns == table.columns
    alone = corpus_pipeline.one_of_near_duplicates(spark, good, FOLDER)
    assert alone.columns == table.columns
    near = {r.doc_id: r.component_id for r in queries.neardup.link(good).collect()}
    assert sorted(r.doc_id for r in alone.select("doc_id").collect()) == sorted(set(near.values()))
    clean = corpus_pipeline.without_benchmark(spark, alone, FOLDER)
    assert 0 < clean.count() <= alone.count()
    hidden = corpus_pipeline.with_pseudonyms(spark, clean, FOLDER)
    assert hidden.columns == table.columns and hidden.count() == clean.count()
    assert hidden.where(F.char_length("text") != F.col("n_chars")).count() == 0
    packed = corpus_pipeline.packed(spark, hidden, FOLDER).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in clean.select("doc_id").collect()}
    by = defaultdict(int)
    for p in packed.itertuples():
        by[p.doc_id] += p.length
    assert all(by[p.doc_id] == p.doc_tokens for p in packed.itertuples())
