"""From raw documents to packed sequences; every stage is one operator of ``nearfield.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.langid import fit_languages, keep_identified
from nearfield.llm.mixing import mix_sources
from nearfield.llm.packing import pack_documents
from nearfield.llm.simhash import simhash_dedup
from nearfield.llm.substring import remove_repeats
from nearfield.session import cut_lineage, ship_with_tasks

ship_with_tasks()

BATCH_BYTES = 8 << 20

# Language models, SimHash and packing have no SQL form; tests compare the rows with brute force.
ORACLE_SQL = None


def bound_batches(spark: SparkSession) -> None:
    """Documents go to Python in Arrow batches of so many bytes at most, however long they are (Spark's default is 64 MB)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go, and those for which no language is likelier than all others."""
    bound_batches(spark)
    return keep_identified(docs, fit_languages(docs, sample_key=F.col("doc_id")), least=0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose SimHashes of three-word shingles link at two or fewer bits."""
    bound_batches(spark)
    return simhash_dedup(docs, shingle=3, distance=2)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of an earlier one; ``n_chars`` follows the text."""
    bound_batches(spark)
    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their places."""
    bound_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("mixing_sources", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
