"""What the language model moves for the places of words that are not near, and writes on its way."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from curvemill.llm import common, lm

TEXTS = ["far out far out far far", "a b a b a b far", None, "", "a b new b a out", "b out a out far b",
         "a b c a b c", "unseen words only here", "c b a far far b"]


def _scores(spark) -> dict:
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    return {r.doc_id: r for r in lm.score(docs.repartition(3)).collect()}


def test_counts_too_large_to_send_along_are_summed_before(spark, monkeypatch):
    plain = _scores(spark)
    monkeypatch.setattr(lm, "NEAR_WORDS", 2)    # all words but two meet their class in the join
    sent = _scores(spark)
    monkeypatch.setattr(lm, "MANY", 3)
    summed = _scores(spark)
    assert any(r.n_known > 1 for r in plain.values())
    for key, r in plain.items():
        assert (r.n_tokens, r.n_known) == (sent[key].n_tokens, sent[key].n_known) \
            == (summed[key].n_tokens, summed[key].n_known)
        assert r.base_score == pytest.approx(sent[key].base_score, rel=1e-12)
        assert sent[key].base_score == pytest.approx(summed[key].base_score, rel=1e-12)
        assert sent[key].score == pytest.approx(summed[key].score, rel=1e-12)


def test_a_path_takes_a_byte_a_word_into_the_join():
    of = np.array([3, 0, lm.CLASSES - 1])
    path = np.array([0, lm.FAR, 2, 1], np.uint16).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([path, b""], pa.binary())],
                                       ["uid", "path"])
    done, = lm._classes_on(of, ["uid"])(iter([batch]))
    assert done.column("uid").to_pylist() == [7, 8]
    assert [list(p) for p in done.column("path").to_pylist()] == [
        [3, lm.OPEN, lm.CLASSES - 1, 0], []]


def test_large_tables_are_written_small(spark):
    with common.recorded() as paths:
        _scores(spark)
    for name in ("lm-words", "lm-near", "lm-classes", "lm-bigrams"):
        path, = [p for p in paths if f"/{name}-" in p]
        files = list(Path(path.removeprefix("file:")).glob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)
