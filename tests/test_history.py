import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from stockyard.operators.asof import asof_join, or_unknown
from stockyard.operators.dedup import keep_latest
from stockyard.operators.quality import history_counts
from stockyard.operators.scd2 import apply_changes, current_versions, late_rows, sync_history

DIM = "sk BIGINT, id STRING, name STRING, effective_start TIMESTAMP_NTZ, effective_end TIMESTAMP_NTZ, is_current BOOLEAN, row_hash STRING"
END = "9999-12-31 00:00:00"
LOAD = "2030-01-01 00:00:00"


def snapshot(rows, *data):
    """Latest row per key with its hash, as a load would see it."""
    df = keep_latest(rows("id STRING, name STRING, src_ts TIMESTAMP_NTZ", *data), ["id"], ["src_ts"])
    return df.withColumn("source_hash", F.sha2("name", 256))


def load(dim, source, **how):
    return apply_changes(dim, source, "id", "sk", LOAD, **how)


BATCHES = [
    [("C1", "Ana", "2026-01-01 00:00:00"), ("C1", "Old", "2025-12-01 00:00:00"), ("C2", "Bia", "2026-01-01 00:00:00")],
    [("C1", "Ana2", "2026-02-10 15:00:00"), ("C2", "Bia", "2026-02-10 00:00:00"), ("C3", "Cid", "2026-02-10 00:00:00")],
    [("C2", "Bia0", "2025-06-01 00:00:00")],
]
WALK = {
    (1, "C1", "Ana", "2026-01-01 00:00:00", "2026-02-10 15:00:00", False),
    (3, "C1", "Ana2", "2026-02-10 15:00:00", END, True),
    (2, "C2", "Bia", "2026-01-01 00:00:00", "2025-06-01 00:00:00", False),
    (5, "C2", "Bia0", "2025-06-01 00:00:00", END, True),
    (4, "C3", "Cid", "2026-02-10 00:00:00", END, True),
}


def versions(dim):
    return as_set(dim.select("sk", "id", "name", F.col("effective_start").cast("string"), F.col("effective_end").cast("string"), "is_current"))


@pytest.fixture
def walk(rows):
    dim = rows(DIM)
    for batch in BATCHES:
        dim = load(dim, snapshot(rows, *batch))
    return dim.cache()


def test_golden_walk(walk):
    assert versions(walk) == WALK


def test_reload_changes_nothing(rows, walk):
    assert versions(load(walk, snapshot(rows, *BATCHES[2]))) == WALK


def test_change_and_revert_makes_three_versions(rows):
    dim = rows(DIM)
    for name, day in (("A", "01"), ("B", "02"), ("A", "03")):
        dim = load(dim, snapshot(rows, ("C", name, f"2026-01-{day} 00:00:00")))
    assert [r.name for r in dim.orderBy("sk").collect()] == ["A", "B", "A"]
    assert current_versions(dim).count() == 1


def test_missing_time_uses_the_load_time_on_both_sides(rows):
    dim = load(load(rows(DIM), snapshot(rows, ("C", "A", None))), snapshot(rows, ("C", "B", None)))
    assert {(r[3], r[4]) for r in versions(dim)} == {(LOAD, LOAD), (LOAD, END)}


def test_null_stored_hash_is_frozen(rows):
    dim = rows(DIM, (1, "C", "A", "2026-01-01 00:00:00", END, True, None))
    assert versions(load(dim, snapshot(rows, ("C", "B", "2026-02-01 00:00:00")))) == versions(dim)


def test_several_current_versions(rows):
    source = snapshot(rows, ("C", "A", "2026-03-01 00:00:00"))
    kept = source.first().source_hash
    dim = rows(DIM, (1, "C", "A", "2026-01-01 00:00:00", END, True, kept), (2, "C", "B", "2026-02-01 00:00:00", END, True, "other"))
    after = load(dim, source)
    assert {(r[0], r[5]) for r in versions(after)} == {(1, True), (2, False)}


def test_late_rows_can_be_rejected(rows):
    dim = rows(DIM)
    for batch in BATCHES[:2]:
        dim = load(dim, snapshot(rows, *batch))
    late = snapshot(rows, *BATCHES[2], ("C4", "Dov", "2025-01-01 00:00:00"))
    assert as_set(late_rows(dim, late, "id"), "id") == {("C2",)}
    after = versions(load(dim, late, late="reject"))
    assert {(r[1], r[2]) for r in after} == {("C1", "Ana"), ("C1", "Ana2"), ("C2", "Bia"), ("C3", "Cid"), ("C4", "Dov")}
    with pytest.raises(ValueError):
        load(dim, late, late="maybe")


def test_asof_golden(rows, walk):
    want = {("2025-07-01", 0, 5, 0), ("2026-01-15", 1, 5, 0), ("2026-02-09", 1, 5, 0), ("2026-02-10", 3, 5, 0), ("2026-03-01", 3, 5, 0)}
    facts = rows("n INT, day DATE, c STRING", *[(i, day[0], c) for i, day in enumerate(sorted(want)) for c in ("C1", "C2", "C9", None)])
    for hot in (None, {"C1": 3}):
        joined = asof_join(facts, walk, "c", "id", "day", {"sk": "found"}, hot=hot, spread="n").select("day", "c", or_unknown("found"))
        assert joined.count() == facts.count()
        got = {}
        for day, c, sk in joined.collect():
            got.setdefault(str(day), {})[c] = sk
        assert {(d, g["C1"], g["C2"], g["C9"]) for d, g in got.items()} == want
        assert {g[None] for g in got.values()} == {0}


def test_version_within_one_day_matches_nothing(rows):
    dim = rows(DIM, (1, "C", "A", "2026-01-01 08:00:00", "2026-01-01 10:00:00", False, "h"), (2, "C", "B", "2026-01-01 10:00:00", END, True, "h"))
    facts = rows("day DATE, c STRING", ("2026-01-01", "C"))
    assert as_set(asof_join(facts, dim, "c", "id", "day", {"sk": "found"}), "found") == {(2,)}


def test_history_copy(rows, walk):
    first = load(rows(DIM), snapshot(rows, *BATCHES[0]))
    assert versions(sync_history(sync_history(rows(DIM), first, "sk"), walk, "sk")) == WALK
    coded = versions(sync_history(sync_history(rows(DIM), first, "sk", False), walk, "sk", False))
    assert {r[0] for r in coded if r[4] == END and r[5]} == {1, 2, 3, 4, 5}


def test_history_checks_golden(walk):
    counts = history_counts(walk, "id").first().asDict()
    assert counts == {"scd_multi_curr": 0, "scd_bad_range": 1, "scd_overlap": 1, "scd_missing_hash": 0, "scd_curr_bad_end": 0, "scd_gap": 0}


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_period_wise_pairs_equal_one_window_per_key(spark, period):
    # Key 0 holds a third of the rows; starts repeat, so do whole rows; some ends are NULL.
    day = dt.datetime(2026, 1, 1)
    data = []
    for i in range(600):
        start = day + dt.timedelta(days=(i * 37) % 101, hours=(i * 7) % 3 * 8)
        end = None if i % 41 == 0 else start + dt.timedelta(days=(i * 13) % 9 - 1)
        data.append((str(0 if i % 3 == 0 else i % 17), start, end, i % 5 == 0, None if i % 11 == 0 else "h"))
    df = spark.createDataFrame(data, "nk STRING, effective_start TIMESTAMP_NTZ, effective_end TIMESTAMP_NTZ, is_current BOOLEAN, row_hash STRING")
    df.createOrReplaceTempView("history")
    want = spark.sql("""
        SELECT count_if(effective_end > nxt) AS scd_overlap, count_if(effective_end < nxt) AS scd_gap FROM
        (SELECT *, lead(effective_start) OVER (PARTITION BY nk ORDER BY effective_start, effective_end) AS nxt FROM history)""").first()
    got = history_counts(df, "nk", period).first()
    assert (got.scd_overlap, got.scd_gap) == (want.scd_overlap, want.scd_gap)
    assert got.scd_missing_hash == sum(1 for r in data if r[4] is None)
    assert got.scd_bad_range == sum(1 for r in data if r[2] and r[1] >= r[2])


def test_source_is_read_once_and_late_rows_are_told_apart(spark):
    from stockyard.operators import scd2
    from stockyard.schemas import empty
    reads = spark.sparkContext.accumulator(0)

    def snapshot(*data):
        df = spark.createDataFrame(list(data), "customer_id string, customer_name string, source_hash string, src_ts timestamp_ntz")
        noted = F.udf(lambda x: reads.add(1) or x, "string").asNondeterministic()
        missing = ("tax_id", "email", "state", "city", "zip_code", "address", "phone", "is_active")
        return df.withColumn("customer_name", noted("customer_name")).withColumns({c: F.lit(None).cast("string") for c in missing})

    at = lambda day: dt.datetime(2026, 1, day)
    first = snapshot(("a", "A", "h1", at(10)), ("b", "B", "h1", at(10)), ("c", "C", "h1", at(10)), ("d", "D", None, at(10)))
    load = lambda dim, source, **how: scd2.apply_changes(dim, source, "customer_id", "customer_sk", "2026-01-31 00:00:00", **how)
    dim = load(empty(spark, "silver.dim_cliente_scd"), first).checkpoint()
    assert reads.value == 4 and dim.count() == 4
    reads.value = 0
    second = snapshot(("a", "A2", "h2", at(20)), ("b", "B2", "h2", at(5)), ("c", "C", "h1", at(20)), ("d", "D2", "h2", at(20)), ("e", "E", "h1", at(20)))
    rejected = load(dim, second, late="reject").checkpoint()
    assert reads.value == 5  # the extract is read once
    rows = {(r.customer_id, r.row_hash, r.is_current) for r in rejected.collect()}
    assert rows == {("a", "h1", False), ("a", "h2", True), ("b", "h1", True), ("c", "h1", True), ("d", None, True), ("e", "h1", True)}
    accepted = {(r.customer_id, r.row_hash, r.is_current) for r in load(dim, second).collect()}
    assert accepted == rows - {("b", "h1", True)} | {("b", "h1", False), ("b", "h2", True)}
