"""Registered queries of the package, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.llm import (frames, html_text, leaks, licenses, lm, neardup, negatives, packing,
                           pii, quality, secrets, sharding, sql, warc)
from curvemill.llm.common import table, write
from curvemill.staging import shared_folder

SHARDS = 24
PSEUDONYM_KEY = "curvemill"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages"))
    return found.select("page_id", "text", F.char_length("text").cast("bigint").alias("n_chars"),
                        F.size(F.filter(F.split("text", "\n"), lambda x: x != ""))
                        .cast("bigint").alias("n_lines"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == F.lit(kind))).cast("bigint")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"), count("literal").alias("n_literal"),
        count("constant").alias("n_constant"))


def op3_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done, found = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return done.select("doc_id", "text", F.size(found).cast("bigint").alias("n_values"), F.array_join(
        F.transform(found, lambda s: s["kind"]), ",").alias("kinds"))


def op4_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


def op5_nnls_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_pieces(table(spark, folder, "documents"), tokenizer_path(),
                                 ordered=False).drop("ids")


def op6_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = write(sharding.deal(table(spark, folder, "documents"), SHARDS), "shards", codec="zstd").df
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return dealt.select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
                        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
                        F.col("shard").cast("int").alias("shard"),
                        F.col("slot").cast("bigint").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    base = F.transform("phrases", lambda p: p["label"])
    more = F.transform("blocks", lambda b: b["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    word = F.transform("phrases", lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(best).alias("score"))


def op8_odd_sketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.link(table(spark, folder, "documents")).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_positional_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found, leak = leaks.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                             keep=["doc_id"])
    items = F.col(f"{leak}.items")
    return found.select(
        "doc_id", f"{leak}.n_words", f"{leak}.n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col(f"{leak}.n_hit") > 0).alias("contaminated"))


def op9_proximity_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The second half of op9, apart from it because its SQL fixes the columns of the first."""
    found, leak = leaks.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                             keep=["doc_id"])
    items = F.col(f"{leak}.near_items")
    return found.select(
        "doc_id", f"{leak}.n_words", f"{leak}.n_hit", f"{leak}.n_near",
        F.size(items).cast("bigint").alias("n_near_items"),
        F.array_join(items, ",").alias("near_items"), (F.col(f"{leak}.n_hit") > 0).alias("contaminated"))


def op10_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    found, rules = quality.judge(table(spark, folder, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[f"{rules}.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept")])


def op11_seekable_fim(spark: SparkSession, folder: str) -> DataFrame:
    stored, name = frames.store(table(spark, folder, "documents"), keep=["doc_id"])
    done, fim = frames.transform(write(stored, "fim-frames", codec="uncompressed").df, name, "doc_id")
    restored = frames.restore(F.col(f"{fim}.output"), F.col(f"{fim}.form"))
    return done.select("doc_id", *[f"{fim}.{c}" for c in (
        "n", "form", "prefix_chars", "middle_chars", "output_sha256")],
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


def op12_zstd_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, folder, "pages"), archives)
    found = warc.read_archives(spark, archives, payloads=False)
    valid = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("path", F.lit(": "), "error")))
    return found.select(
        F.coalesce(valid.cast("bigint"), F.col("key").cast("bigint")).alias("page_id"),
        "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint"))


def op13_segment_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), label=shifted,
                          anchors=F.col("vec_id") % 50 == 0, scale=256.0)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {q.__name__: q for q in (
    op1_html_extraction, op2_secret_scan, op3_pii_pseudonyms, op4_class_lm, op5_nnls_packing,
    op6_hypergeometric_shards, op7_license_scan, op8_odd_sketch_dedup,
    op9_positional_decontamination, op9_proximity_matches, op10_host_quality, op11_seekable_fim,
    op12_zstd_warc, op13_segment_negatives, pipeline)}

SQL: dict[str, str] = dict(sql.SQL)
