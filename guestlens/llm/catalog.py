"""The registered queries of this package and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from guestlens.llm import (
    alignment,
    bitpack,
    codebooks,
    language,
    licences,
    mixing,
    neardups,
    neighbours,
    oracle,
    packing,
    quality,
    secrets,
    substrings,
    wordpieces,
)
from guestlens.llm.tables import documents, stored
from guestlens.llm.tokens import END_ID, tokenizer_file
from guestlens.sources.shared import shared_folder

def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.sampled_mix(documents(spark, sf_dir))
    taken = F.col("size") * F.col("copies")
    return mix.select("doc.doc_id", "size", "source_size", "target", taken.alias("taken"))


def op2_pack_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-ids")
    shards = bitpack.write_shards(documents(spark, sf_dir), folder, tokenizer_file("word_bpe_49k.json"), END_ID)
    return bitpack.read_shards(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_remove_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.without_repeats(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_count_word_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpieces.token_counts(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(documents(spark, sf_dir))
    return rows.select(
        "doc.doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    )


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), END_ID)


def op8_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = language.train(docs.where(fold != 0))
    rows = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return language.predicted(rows, model, ["doc_id", "held_out"])


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neardups.near_duplicates(documents(spark, sf_dir), size=3, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scanned(documents(spark, sf_dir))
    count = lambda name: F.size(F.filter("base", lambda x: x["kind"] == secrets.KINDS.index(name))).cast("long")
    return rows.select(
        "doc.doc_id",
        *[count(k[0]).alias(f"n_{k[0]}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.described(F.col("base")), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


def op11_scan_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.licensed(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        "score",
    )


def op12_compress_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = codebooks.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return rows.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignments(
        documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    )
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = stored(found.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    sums = alignment.scored(rows)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    documents_only = rows.where("row IS NOT NULL").select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    return documents_only.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", *counts, "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pack_token_ids": op2_pack_token_ids,
    "op3_remove_repeated_passages": op3_remove_repeated_passages,
    "op4_count_word_pieces": op4_count_word_pieces,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_quality_rules": op6_quality_rules,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_identify_language": op8_identify_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_secret_scan": op10_secret_scan,
    "op11_scan_licences": op11_scan_licences,
    "op12_compress_vectors": op12_compress_vectors,
    "op13_align_tokenizers": op13_align_tokenizers,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": oracle.MIX,
    "op3_remove_repeated_passages": oracle.PASSAGES,
    "op6_quality_rules": oracle.QUALITY,
    "op9_near_duplicates": oracle.NEAR_DUPLICATES,
    "op10_secret_scan": oracle.SECRETS,
    "op12_compress_vectors": oracle.CODEBOOKS,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
