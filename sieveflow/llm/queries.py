"""The registered queries of this subpackage: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveflow.llm import (
    ann, codebooks, langid, mixing, outliers, packing, rangejoin, secrets, sharding, simhash, spelling, tokenfile, tokens,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over ``documents``; learns from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(langid.learnable(docs))
    rows = langid.predict_language(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over ``documents``: four-word shingles, up to 4 differing bits."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over ``documents``: 24 shards of near-equal bytes."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 24)


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over ``embeddings``: cosine of at least 0.98 within a label."""
    return rangejoin.vector_components(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over ``documents``."""
    return mixing.mix_plan(_table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over ``embeddings``: the 20 nearest of every 20th id."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over ``documents``."""
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=1024)


def packed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over ``documents``."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over ``documents``."""
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over ``documents``: written as ORC and read back."""
    return tokenfile.token_table(_table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=1)


def quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over ``documents``."""
    return outliers.reject_outliers(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", *outliers.BASE, "base_failed", "kept")


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over ``embeddings``: 4 parts, 256 entries, 4 rounds."""
    return codebooks.vector_codes(_table(spark, sf_dir, "embeddings"))


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over ``documents``."""
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id,
    "op2_simhash_groups": simhash_groups,
    "op3_shards": shards,
    "op4_embedding_links": embedding_links,
    "op5_source_mix": source_mix,
    "op6_nearest_vectors": nearest_vectors,
    "op7_token_counts": token_counts,
    "op8_packed_batches": packed_batches,
    "op9_secret_scan": secret_scan,
    "op10_token_files": token_files,
    "op11_quality_outliers": quality_outliers,
    "op12_vector_codes": vector_codes,
    "op13_spelling_groups": spelling_groups,
}
