"""The corpus pipeline: five operators one after the other over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; what it returns is written as Parquet in the shared checkpoint folder
and read back for the next stage, so a lost executor costs one stage at most.
All but the last return the columns of ``documents``.

The stages that hand whole texts to Python bound the bytes of a batch in the
session (``bound_batches``), as they are written after they have returned: the
executors' memory then depends neither on the length of the texts nor on the
columns that come with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveflow.llm.langid import UNKNOWN, fit, learnable, predict_language
from sieveflow.llm.mixing import mix_documents
from sieveflow.llm.packing import pack
from sieveflow.llm.secrets import redact_secrets
from sieveflow.llm.simhash import simhash_dedup
from sieveflow.session import bound_batches, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: texts without a letter (null and empty ones too) go; a
    missing ``lang`` is filled in, or stays null when there was nothing to
    learn from."""
    bound_batches(spark)
    model = fit(learnable(docs))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    cols = docs.columns
    rows = predict_language(docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc"), "text"),
                            model, lang_col="_lang_pred", score_col="_score")
    kept = rows.where(F.col("_lang_pred") != UNKNOWN)
    return kept.select(*[F.coalesce(F.col("_doc.lang"), F.col("_lang_pred")).alias("lang") if c == "lang"
                         else F.col(f"_doc.`{c}`").alias(c) for c in cols])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each SimHash group stays, the one with the
    smallest id."""
    bound_batches(spark)
    return simhash_dedup(docs, shingle=4, distance=4)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: secrets are replaced by a mark; every document stays."""
    bound_batches(spark)
    return redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix takes them (0 to 2 times)."""
    return mix_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per packed sequence."""
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("secret_scan", remove_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_batches),
]

#: a learned model, XXH64 and checksums are beyond SQL: tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
