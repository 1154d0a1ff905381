"""A training corpus from raw documents: each stage's rows are written and read again as the next one's documents."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm.exact_dedup import drop_duplicates
from stockyard.llm.language_id import language_rejects
from stockyard.llm.mixing import mix
from stockyard.llm.near_dedup import drop_near_duplicates
from stockyard.llm.packing import pack
from stockyard.llm.rows import WORD, table, whole, without
from stockyard.sources.shared_dir import shared_dir


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages."""
    return without(docs, language_rejects(docs))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    size = F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long")
    return mix(docs, F.col("source"), size, F.col("doc_id"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens, their ids as a checksum."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("language_id", identify_languages), ("exact_dedup", dedup_exact), ("near_dedup", dedup_near), ("mix_sources", mix_sources), ("pack", pack_windows)]

#: Language models, signatures and packing are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
