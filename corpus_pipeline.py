"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All stages but the last return
the columns of documents, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.llm import mixing, neardups, packing, quality, secrets
from guestlens.llm.tables import documents, only, stored
from guestlens.llm.tokens import END_ID, tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts are rejected."""
    return only(quality.judged(docs), F.col("kept"), "doc").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8 or more)."""
    return neardups.one_per_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan reports masked; n_chars follows the text."""
    scan = secrets.scanned(docs)
    field = F.col("doc").getField
    text = secrets.redacted(field("text"), F.col("spans"))
    changed = {"text": text, "n_chars": F.when(F.size("spans") == 0, field("n_chars")).otherwise(F.length(text))}
    kinds = dict(docs.dtypes)
    return scan.select(*[changed.get(c, field(c)).cast(kinds[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix holds them: not at all, once or twice."""
    mix = mixing.sampled_mix(docs).where("copies > 0")
    return mix.select("doc", F.explode(F.expr("sequence(1L, copies)"))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, with their sequence and place in it."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("secret scans", secret_scans),
    ("source mixing", mix_sources),
    ("best-fit packing", pack),
]

#: Sketches and tokenizers cannot be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
