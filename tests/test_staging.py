"""What a load leaves in the shared folder, and merges that read the partitions they replace."""

import os

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from stockyard.sources import bronze, tables
from stockyard.sources.shared_dir import shared_dir, staged, tidy_shuffles
from stockyard.streaming import incremental
from stockyard.plans import silver

SCHEMA, TABLE = "carrier_code STRING, carrier_name STRING, website STRING, row_hash STRING", "silver.dim_transportadora"


def left_over(spark):
    """Checkpoints and staged rows in the shared folder."""
    return {f"{at}/{d}" for at, folders, _ in os.walk(shared_dir(spark)) for d in folders if d.startswith(("rdd-", "staged-"))}


def merger(rows, root):
    part = F.col("website").try_cast("int")
    return lambda *data: tables.merge_changes(rows(SCHEMA, *data), root, TABLE, ["carrier_code"], "p", part)


def test_merge_leaves_no_copy_of_the_source(spark, rows, tmp_path):
    merge, before = merger(rows, str(tmp_path)), left_over(spark)
    merge(("a", "1", "1", "h"), ("b", "1", "2", "h"))
    now, changed = merge(("a", "2", "3", "h2"), ("b", "2", "2", "h"), ("c", "1", "2", "h"))
    assert left_over(spark) == before
    assert as_set(now, "carrier_code", "carrier_name") == {("a", "2"), ("b", "1"), ("c", "1")}
    assert as_set(changed, "carrier_code") == {("a",), ("c",)}


def test_merge_finds_a_key_in_three_partitions(spark, rows, tmp_path):
    merge = merger(rows, str(tmp_path))
    merge(("a", "1", "1", "h"), ("b", "1", "2", "h"))
    for n in ("2", "3"):
        stray = tables.conform(rows(SCHEMA, ("a", "1", n, "h")), TABLE).withColumn("p", F.lit(int(n)))
        stray.write.mode("append").partitionBy("p").parquet(f"{tmp_path}/silver/dim_transportadora/parts")
    now, _ = merge(("a", "1", "1", "h"))
    assert sorted(map(tuple, now.collect())) == [("a", "1", "1", "h"), ("b", "1", "2", "h")]
    assert not os.path.exists(f"{tmp_path}/silver/dim_transportadora/parts/p=3")


def test_null_keys_stay_one_row(spark, rows, tmp_path):
    merge = merger(rows, str(tmp_path))
    merge((None, "1", "1", "h"), ("b", "1", "2", "h"))
    now, _ = merge((None, "2", "1", "h2"), ("b", "2", "2", "h"))
    assert sorted(map(tuple, now.select("carrier_code", "carrier_name").collect()), key=str) == [("b", "1"), (None, "2")]


def test_ranked_stream_leaves_no_copy_of_its_batches(spark, tmp_path):
    from test_lake import drop, header_row
    before = left_over(spark)
    for number, data in enumerate([[header_row("1", status="C", update="2026-01-12 00:00:00")], [header_row("1", status="P", update="2026-01-11 00:00:00"), header_row("2")]]):
        drop(spark, f"{tmp_path}/raw", "OPKL", data, f"2026010{number + 1}_000000")
        incremental.upsert_stream(bronze.stream_bronze(spark, "OPKL", f"{tmp_path}/raw"), silver.header, f"{tmp_path}/lake", "silver.opkl_clean", ["pick_list_id"],
                                  f"{tmp_path}/checkpoint", silver.header_partition(), silver.header_ranking())
    assert as_set(tables.read_table(spark, f"{tmp_path}/lake", "silver.opkl_clean"), "pick_list_id", "status") == {("1", "C"), ("2", "E")}
    assert left_over(spark) == before


def test_staged_rows_go_with_their_block_and_the_setting_comes_back(spark):
    setting, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", left_over(spark)
    was = spark.conf.get(setting)
    with staged(spark) as stage, tidy_shuffles(spark):
        assert stage(spark.range(5)).count() == 5 and spark.conf.get(setting) == "true"
    assert left_over(spark) == before and spark.conf.get(setting) == was


def test_hot_keys_are_found_without_moving_the_others(spark):
    from stockyard.operators.skew import find_hot
    key = F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 4 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), "id"))
    df = spark.range(4000).select(key.alias("k"), (F.col("id") + 0).cast("string").alias("own"))
    assert find_hot(df, ["k", "own"], tasks=8) == {"k": {"hot": 2}, "own": {}}


def test_hot_keys_are_counted_by_bucket_first(spark, monkeypatch):
    from stockyard.operators.skew import find_hot
    df = spark.range(4000).select(F.col("id").cast("string").alias("own"))
    seen, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    assert find_hot(df, ["own"], tasks=8) == {"own": {}}
    assert len(seen) == 1 and "bucket" in seen[0]


def test_entry_sets_the_method_limit_for_the_lakehouse_only(spark, monkeypatch):
    import __spark_entry__ as entry
    name = "spark.sql.codegen.hugeMethodLimit"
    monkeypatch.setattr(entry.registry, "queries", lambda: {"lake": lambda spark, d: spark.conf.get(name)})
    assert entry.queries()["lake"](spark, "") == "8000"
    monkeypatch.setattr(entry.llm, "queries", lambda: {"text": lambda spark, d: spark.conf.get(name)})
    assert entry.queries()["text"](spark, "") != "8000"
    entry.queries()["lake"](spark, "")


def test_a_picklist_fact_shuffles_its_lines_once_before_they_are_weighed(spark, rows):
    raw = rows("AbsEntry STRING, PickEntry STRING, OrderEntry STRING, ItemCode STRING, RelQtty STRING, PickQtty STRING",
               ("1", "1", "1", "P1", "2", "2"), ("1", "1", "1", "P1", "1", "1"), ("2", "1", "2", "P2", "3", "3"))
    at = "2026-01-01 00:00:00"
    dealt = silver.lines(raw, at, by_picklist=True)
    assert as_set(dealt) == as_set(silver.lines(raw, at)) and dealt.count() == 2
    per_picklist = dealt.groupBy("pick_list_id", "item_code").count()
    assert per_picklist._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def commits_of(monkeypatch):
    """The partitions that each commit of a merge enters, in order; merges take a commit for every row or few."""
    monkeypatch.setattr(tables, "_COMMIT_ROWS", 1)
    seen, write = [], tables._write_parts

    def written(rows, path, part, value, replace=False):
        seen.extend([{r.p for r in rows.select(value.cast("string").alias("p")).distinct().collect()}] if replace else [])
        return write(rows, path, part, value, replace)

    monkeypatch.setattr(tables, "_write_parts", written)
    return seen


@pytest.mark.parametrize("by_key", [True, False])
def test_merge_replaces_partitions_in_several_commits(spark, rows, tmp_path, monkeypatch, by_key):
    part, seen = F.col("carrier_code").substr(1, 1), commits_of(monkeypatch)
    merge = lambda *data: tables.merge_changes(rows(SCHEMA, *data), str(tmp_path), TABLE, ["carrier_code"], "p", part, by_key)
    merge(*[(f"{c}{i}", "1", c, "h") for c in "abcd" for i in range(3)], (None, "1", "x", "h"))
    new = [("a1", "2", "a", "h2"), ("b1", "1", "b", "h"), ("c1", "2", "c", "h2"), ("d9", "1", "d", "h"), ("e1", "1", "e", "h")]
    now, changed = merge(*new)
    assert as_set(changed) == {("a1",), ("c1",), ("d9",), ("e1",)}
    assert as_set(now) == {(f"{c}{i}", "1", c, "h") for c in "abcd" for i in range(3)} - {("a1", "1", "a", "h"), ("c1", "1", "c", "h")} | set(new) | {(None, "1", "x", "h")}
    assert now.count() == 15 and seen == [{"a"}, {"c"}, {"d"}, {"e"}]
    again, none = merge(*new)
    assert len(seen) == 4 and none.count() == 0 and as_set(again) == as_set(now)


def test_partitions_between_which_a_row_moves_share_a_commit(spark, rows, tmp_path, monkeypatch):
    seen, merge = commits_of(monkeypatch), merger(rows, str(tmp_path))
    merge(*[(f"k{p}{i}", "1", str(p), "h") for p in range(1, 6) for i in range(2)], ("gone", "1", "8", "h"), ("z", "1", None, "h"))
    now, changed = merge(("k10", "2", "4", "h2"), ("k20", "2", "2", "h2"), ("gone", "2", "5", "h2"), ("z", "2", None, "h2"), ("n", "1", "9", "h"))
    assert sorted(map(sorted, [{p or "-" for p in c} for c in seen])) == [["-"], ["1", "4"], ["2"], ["5"], ["9"]]
    assert as_set(changed) == {("k10",), ("k20",), ("gone",), ("z",), ("n",)} and now.count() == 13
    assert {("k10", "2"), ("k20", "2"), ("gone", "2"), ("z", "2"), ("n", "1"), ("k11", "1")} <= as_set(now, "carrier_code", "carrier_name")
    assert not os.path.exists(f"{tmp_path}/silver/dim_transportadora/parts/p=8")


def test_few_rows_take_one_commit_and_many_a_bounded_number():
    assert tables._commits({"a": 5, "b": 400_000, "c": 1}) == [{"a", "b", "c"}]
    many = tables._commits({f"{n:03}": 1_000_000 for n in range(320)})
    assert len(many) == tables._COMMITS and sorted(set().union(*many)) == [f"{n:03}" for n in range(320)] and sum(map(len, many)) == 320
    assert tables._commits({"a": 10**9, "b": 1, "c": 10**9, "d": 10**9}, [("d", "a"), ("d", "a")]) == [{"a", "d"}, {"b"}, {"c"}]
    assert tables._commits({}) == []


def test_in_turn_cuts_rows_and_stored_rows_alike(spark, rows, tmp_path, monkeypatch):
    merge = merger(rows, str(tmp_path))
    merge(("a", "1", "1", "h"), ("b", "1", "2", "h"), ("c", "1", None, "h"), ("d", "1", "4", "h"))
    monkeypatch.setattr(tables, "_COMMIT_ROWS", 1)
    asked = rows("id STRING, website STRING", ("x", "2"), ("y", None), ("z", "3"), ("w", "2"))
    got = [(as_set(mine, "id"), as_set(there, "carrier_code")) for mine, there in tables.in_turn(asked, str(tmp_path), TABLE, "p", F.col("website").try_cast("int"))]
    assert sorted(got, key=lambda pair: min(pair[0])) == [({("x",), ("w",)}, {("b",)}), ({("y",)}, {("c",)}), ({("z",)}, set())]


def test_merge_keeps_no_copy_of_changed_rows(spark, rows, tmp_path):
    rows_of = lambda: {d for d in os.listdir(shared_dir(spark)) if d.startswith("rows-")}
    before = rows_of()
    for data in ([("a", "1", "1", "h")], [("a", "2", "1", "h2"), ("b", "1", "2", "h")]):
        tables.merge_touched(rows(SCHEMA, *data), str(tmp_path), TABLE, ["carrier_code"], "p", F.col("website").try_cast("int"))
    assert rows_of() == before


def test_a_window_built_and_merged_in_turn_gives_the_same_fact(spark, monkeypatch):
    from stockyard.plans import registry
    scratch, merged, stepwise = lambda: {d for d in os.listdir(shared_dir(spark)) if d.startswith("staged-")}, [], []
    before, write = scratch(), tables._write_parts
    monkeypatch.setattr(tables, "_write_parts", lambda *args, **how: merged.append(args[1]) or write(*args, **how))
    whole = registry.queries()["refresh_window"](spark, "/root/testdata/sf0.001")
    few, ranges = len(merged), silver.line_partition
    monkeypatch.setattr(silver, "line_partition", lambda: ranges(ids=300))
    monkeypatch.setattr(tables, "_COMMIT_ROWS", 1)
    turn = tables.in_turn
    from stockyard.plans import refresh
    monkeypatch.setattr(refresh, "in_turn", lambda *args: (stepwise.append(1) or some for some in turn(*args)))
    parted = registry.queries()["refresh_window"](spark, "/root/testdata/sf0.001")
    assert len(stepwise) > 3 and len(merged) - few > few + 10
    assert sorted(map(tuple, parted.collect())) == sorted(map(tuple, whole.collect())) and whole.count() > 0
    assert scratch() == before


def test_a_drop_is_written_compressed_and_in_files_of_bounded_length(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "_DROP_ROWS", 2)
    sites = rows("TrnspCode STRING, TrnspName STRING, WebSite STRING", *[(f"T{n}", "a;b", "é" if n % 2 else None) for n in range(5)]).coalesce(1)
    bronze.write_drop(sites, "OSHP", str(tmp_path), "20260101_000000")
    files = [f for f in os.listdir(tmp_path / "OSHP" / "OSHP_20260101_000000.csv") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert as_set(bronze.read_bronze(spark, "OSHP", str(tmp_path))) == as_set(sites)
    assert as_set(bronze.read_bronze(spark, "OSHP", str(tmp_path), since="2026-01-01 00:00:00")) == as_set(sites)


def test_keys_follow_the_order_over_all_files_of_the_staged_rows(spark, monkeypatch):
    from stockyard.operators.keys import assign_surrogate_keys
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        df = spark.range(100).select((F.col("id") * 37 % 100).cast("bigint").alias("nk")).repartition(5)
        numbered = assign_surrogate_keys(df, "sk", ["nk"], above=10)
        assert sorted(map(tuple, numbered.collect())) == [(n + 11, n) for n in range(100)]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
