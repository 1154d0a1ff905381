import pytest
from conftest import as_set
from pyspark.sql import functions as F

from stockyard.operators.dedup import keep_latest, repeated_keys
from stockyard.operators.keys import assign_surrogate_keys, with_member
from stockyard.operators.skew import find_hot, lookup
from stockyard.operators.upsert import changed_rows, upsert, upsert_numbered

S = "k STRING, v STRING, row_hash STRING"


def test_hash_guard(rows):
    target = rows(S, ("same", "old", "h"), ("changed", "old", "h"), ("unhashed", "old", None), ("gone", "old", "h"))
    source = rows(S, ("same", "new", "h"), ("changed", "new", "h2"), ("unhashed", "new", "h"), ("fresh", "new", "h"))
    after = upsert(target, source, ["k"])
    assert as_set(after) == {("same", "old", "h"), ("changed", "new", "h2"), ("unhashed", "new", "h"), ("gone", "old", "h"), ("fresh", "new", "h")}
    assert as_set(upsert(after, source, ["k"])) == as_set(after)


def test_null_source_hash_updates_only_unhashed_rows(rows):
    target = rows(S, ("a", "old", "h"), ("b", "old", None))
    assert as_set(upsert(target, rows(S, ("a", "new", None), ("b", "new", None)), ["k"])) == {("a", "old", "h"), ("b", "new", None)}


def test_other_guards(rows):
    target, source = rows(S, ("a", "old", "h")), rows(S, ("a", "new", "h"), ("b", "new", "h"))
    assert as_set(upsert(target, source, ["k"], guard="always"), "k", "v") == {("a", "new"), ("b", "new")}
    assert as_set(upsert(target, source, ["k"], guard="insert_only"), "k", "v") == {("a", "old"), ("b", "new")}
    with pytest.raises(ValueError):
        upsert(target, source, ["k"], guard="never")


def test_columns_the_source_lacks_are_kept(rows):
    target = rows("k STRING, extra STRING, row_hash STRING", ("a", "kept", "h"))
    after = upsert(target, rows("k STRING, row_hash STRING", ("a", "h2"), ("b", "h")), ["k"])
    assert as_set(after) == {("a", "kept", "h2"), ("b", None, "h")}


def test_repeated_source_key_fails(rows):
    target, source = rows(S, ("a", "old", "h")), rows(S, ("b", "1", "h"), ("b", "2", "h"))
    for guard in ("hash", "always", "insert_only"):
        with pytest.raises(Exception, match="repeated source key: b"):
            upsert(target, source, ["k"], guard=guard).collect()
    assert as_set(repeated_keys(source, ["k"])) == {("b", 2)}


def test_null_keys_never_match(rows):
    target, source = rows(S, (None, "old", "h")), rows(S, (None, "new", "h2"), (None, "new", "h3"))
    assert upsert(target, source, ["k"]).count() == 3


def test_keep_latest_ignores_input_order(spark, rows):
    df = rows("k STRING, at INT, v STRING", ("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "x"), ("b", 0, "a"), ("c", None, None))
    want = {("a", 2, "y"), ("b", 0, "a"), ("c", None, None)}
    assert as_set(keep_latest(df, ["k"], ["at"])) == want
    assert as_set(keep_latest(df.orderBy(F.rand(1)).repartition(3), ["k"], ["at"])) == want


def test_ranking_is_limited_before_the_shuffle(rows):
    plan = keep_latest(rows("k STRING, at INT", ("a", 1)), ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_surrogate_keys_are_dense_ordered_and_repeatable(spark):
    # A third of all rows share one natural key.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("nk"), F.col("id").alias("at"))
    one = assign_surrogate_keys(df, "sk", ["nk", "at"], above=10)
    two = assign_surrogate_keys(df.repartition(7, "at"), "sk", ["nk", "at"], above=10)
    assert as_set(one) == as_set(two)
    ordered = [tuple(r) for r in one.orderBy("sk").collect()]
    assert [r[0] for r in ordered] == list(range(11, 3011))
    assert [r[1:] for r in ordered] == sorted(r[1:] for r in ordered)
    assert assign_surrogate_keys(df.where("false"), "sk", ["nk"]).count() == 0


def test_numbered_upsert_keeps_keys(rows):
    empty = rows("sk BIGINT, k STRING, v STRING, row_hash STRING")
    first = upsert_numbered(empty, rows(S, ("b", "1", "h"), ("a", "1", "h")), ["k"], "sk")
    assert as_set(first) == {(1, "a", "1", "h"), (2, "b", "1", "h")}
    second = upsert_numbered(first, rows(S, ("b", "2", "h2"), ("a", "2", "h"), ("0", "2", "h")), ["k"], "sk")
    assert as_set(second) == {(1, "a", "1", "h"), (2, "b", "2", "h2"), (3, "0", "2", "h")}


def test_member_is_added_once(rows):
    df = rows("sk BIGINT, k STRING", (1, "a"))
    once = with_member(df, "k", {"sk": F.lit(0), "k": F.lit("_UNKNOWN_")})
    assert as_set(once) == as_set(with_member(once, "k", {"sk": F.lit(0), "k": F.lit("_UNKNOWN_")})) == {(1, "a"), (0, "_UNKNOWN_")}


def test_changed_rows(rows):
    target, source = rows(S, ("a", "1", "h"), ("b", "1", "h"), ("c", "1", None)), rows(S, ("a", "2", "h"), ("b", "2", "x"), ("c", "2", "x"), ("d", "2", "x"))
    assert as_set(changed_rows(target, source, ["k"]), "k") == {("b",), ("d",)}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_salted_lookup_equals_plain(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
        right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("unused", 4)], "r STRING, v INT")
        hot = find_hot(left, ["key"], 6)
        assert hot == {"key": {"hot": 2}}        # a third of 900 rows is two of six shares
        assert find_hot(left.where("false"), ["key"]) == {"key": {}}
        plain = left.join(right, F.col("key") == F.col("r"), "left")
        salted = lookup(left, right, "key", "r", hot=hot["key"], spread="id")
        assert salted.columns == plain.columns
        assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
