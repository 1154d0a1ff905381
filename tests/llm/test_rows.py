"""Row numbers do not depend on how files are split, and clashing names do no harm."""

import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockyard.llm import exact_dedup, fingerprint, language_id, mixing, near_dedup
from stockyard.llm.rows import ROW, numbered, unused, without


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "d")
    texts = [" ".join(f"w{(i // 2 * 7 + k) % 997}" for k in range(40)) for i in range(240)]  # every text twice
    spark.createDataFrame([(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(12).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def split_anew(spark):
    """Runs an action while files are cut and dealt to tasks in another way than when it was planned."""
    def run(action):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "13")
        try:
            return action()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    return run


def test_numbers_are_the_same_for_any_split(docs, split_anew):
    read = lambda: {r.doc_id: r[ROW] for r in numbered(docs).select("doc_id", ROW).collect()}
    first = read()
    assert len(set(first.values())) == 240 and split_anew(read) == first
    assert {r.doc_id: r[ROW] for r in numbered(docs.where("doc_id % 2 = 0").select("doc_id")).collect()}.items() <= first.items()


def test_second_reading_may_be_split_otherwise(spark, docs, split_anew):
    kept = exact_dedup.drop_duplicates(docs)
    assert split_anew(kept.count) == 120
    near = near_dedup.drop_near_duplicates(docs)
    assert split_anew(near.count) == near.count()
    judge = lambda rows: ({"doc_id": d, "a": t, "b": n} for d, t, n in rows)
    beside = fingerprint.beside_next(docs, judge, "doc_id long, a string, b string")
    assert sorted(r.doc_id for r in split_anew(beside.collect)) == list(range(240))
    mixed = mixing.mix(docs, F.col("source"), F.lit(40), F.col("doc_id"))
    want = Counter(r.doc_id for r in mixed.collect())
    assert Counter(r.doc_id for r in split_anew(mixed.collect)) == want
    rejects = without(docs, language_id.language_rejects(docs))
    assert split_anew(rejects.count) == rejects.count()


def test_clashing_names_stay(docs):
    odd = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("__row", "__ROW_gone", "__turn", "_metadata", "a.b", "rep", "key", "shard"))])
    odd = odd.where("doc_id < 40")
    for out in (exact_dedup.drop_duplicates(odd), near_dedup.drop_near_duplicates(odd), mixing.mix(odd, F.col("source"), F.lit(3), F.col("doc_id")),
                without(odd, language_id.language_rejects(odd))):
        assert sorted(out.columns) == sorted(odd.columns)
        assert {(r["__row"], r["__ROW_gone"], r["__turn"], r["a.b"]) for r in out.collect()} == {(0, 1, 2, 4)}
    assert unused(["__Row_x", "a"], "__row") == "___row"


def test_without_labels_no_document_is_rejected(docs):
    assert language_id.language_rejects(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_many_files_are_numbered_by_path(spark, tmp_path):
    spark.range(50).repartition(50).write.parquet(str(tmp_path / "x y%z"))
    got = numbered(spark.read.parquet(str(tmp_path / "x y%z")))
    files = got.select(F.col(ROW).alias("row"), F.shiftright(ROW, 40).alias("file")).collect()
    assert len({r.row for r in files}) == 50 and max(r.file for r in files) < 51 and sys.maxsize >= max(r.row for r in files)
