"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

A text whose length, or whose length and prefix hash, no other text shares is settled without its whole
content; only groups that survive both steps are compared by SHA-256 of the whole normalised text.
Only those texts are hashed then, in a second scan joined with the rows that survive; with ``hash_all`` every
text is hashed in the first scan, which leaves a few numbers per document to move and no texts.

Defined results: NULL and empty texts are equal; of repeated rows that tie in everything one stays; an
empty table gives an empty result. Columns of the input are not touched.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.rows import ROW, SPACE, numbered, whole, without
from stockyard.sources.shared_dir import cut_lineage

PREFIX = 64


def normalised(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.regexp_replace(whole(text), f"{SPACE}+", "")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per document: ``__row, doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points in the original text stays, then the smallest
    ``doc_id`` (NULL last). ``text_sha256`` is NULL where the text was settled without its hash, unless
    ``hash_all`` asks for the hash of every text.
    """
    norm = normalised(F.col(f"`{text}`"))
    read = numbered(docs).select(
        ROW, F.col(f"`{doc_id}`").alias("doc_id"), F.length(whole(F.col(f"`{text}`"))).cast("long").alias("__chars"), norm.alias("__norm"))
    sha = F.sha2("__norm", 256).alias("__sha")
    sketch = cut_lineage(read.select(ROW, "doc_id", "__chars", F.length("__norm").alias("__length"),
                                     F.xxhash64(F.substring("__norm", 1, PREFIX)).alias("__prefix"), *([sha] if hash_all else [])))

    lengths = sketch.groupBy("__length").count().where("count > 1").select("__length")
    bins = (sketch.select("__length", "__prefix").join(lengths, "__length", "left_semi")
            .groupBy("__length", "__prefix").count().where("count > 1").select("__length", "__prefix"))
    survivors = sketch.join(bins, ["__length", "__prefix"], "left_semi")
    if not hash_all:
        # Texts whose length and prefix others share are joined with the rows that survive, then hashed.
        hashed = read.join(survivors.select(F.col(ROW).alias("__r")), F.col(ROW) == F.col("__r"), "left_semi").select(F.col(ROW).alias("__r"), sha)
        survivors = survivors.join(hashed, F.col(ROW) == F.col("__r")).drop("__r")
    order = F.struct((-F.col("__chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col(ROW).alias("d"))
    groups = (survivors.groupBy("__length", "__sha").agg(F.min(order).alias("__best"), F.count("*").alias("group_size"))
              .where("group_size > 1"))
    best = groups.select(F.col("__sha").alias("__group"), F.col("__best.c").alias("keep_id"), F.col("__best.d").alias("__keeps"), "group_size")
    rows = sketch if hash_all else sketch.join(survivors.select(ROW, "__sha"), ROW, "left")
    grouped = rows.join(best, F.col("__sha") == F.col("__group"), "left")
    alone = F.col("__group").isNull()
    return grouped.select(
        ROW, "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(ROW) == F.col("__keeps"))).alias("kept"), F.col("__sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that do not stay; all columns as they were."""
    return without(docs, duplicate_groups(docs, doc_id, text).where(~F.col("kept")))
