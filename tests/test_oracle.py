"""Registered queries against their SQL on the smallest tables. tools/compare.py runs all of them."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(entry.__file__), "tools"))
import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["scan_csv_bronze", "parse_dates", "repair_decimal", "dedup_latest_header", "dedup_latest_line", "dedup_latest_product", "row_hash_header",
         "row_hash_versioned", "calendar_join", "header_with_lines", "upsert_hash_guarded", "upsert_composite_key", "unknown_member", "scd2_customer",
         "sync_history_hash_only", "asof_branch_sk", "fact_upsert", "dq_scd_late", "dq_scd_overlap", "dq_scd_gap", "dq_totals", "operator_productivity",
         "exclude_downtime", "stream_upsert_header", "stream_late_files", "skewed_lookup", "skewed_asof",
         "bronze_drops", "bronze_recent", "operator_dim", "carrier_dim", "merge_moved_partition", "merge_after_publish", "downtime_intervals", "refresh_window", "stream_keyed_state",
         "malformed_lines", "sla_rollup", "branch_hours", "map_cost_center", "map_supervisor", "calendar_dim"]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    ok, _, note = compare.compare(spark, con, SF, name, entry.oracle_sql()[name])
    assert ok, note


def test_every_query_has_sql():
    from stockyard.plans import oracle, registry
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, con):
    assert entry.entry(spark).count() > 0
