"""Mergeable bins against exact quantiles, and the reader of malformed lines."""

import random

import pytest
from pyspark.sql import functions as F

from stockyard.operators.quantiles import bin_counts, bin_quantiles, merge_bins
from stockyard.sources import bronze

SHARES = {"least": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "most": 1.0}


def _rows(spark, values):
    return spark.createDataFrame([(g, i % 5, v) for g, vs in values.items() for i, v in enumerate(vs)], "g string, day int, v bigint")


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_quantiles_of_merged_days_stay_within_the_error(spark, error):
    rng = random.Random(7)
    values = {"wide": [int(10 ** rng.uniform(0, 15)) for _ in range(2000)], "negative": [rng.randint(-9000, 9000) for _ in range(2001)],
              "one": [42], "equal": [7] * 300, "zero": [0, 0, 0], "hot": [rng.randint(700, 1800) for _ in range(20_000)], None: [5, 6]}
    days = bin_counts(_rows(spark, values), "v", ["g", "day"], error)
    merged = bin_quantiles(merge_bins(days, ["g"]), ["g"], SHARES, error)
    direct = bin_quantiles(bin_counts(_rows(spark, values), "v", ["g"], error), ["g"], SHARES, error)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, direct.collect()))
    for row in merged.collect():
        exact = sorted(values[row.g])
        assert row.n == len(exact)
        for name, q in SHARES.items():
            value = exact[int(q * (len(exact) - 1))]
            assert abs(row[name] - value) <= error * abs(value) + 0.5 + 1e-9 * abs(value), (row.g, name)


def test_quantiles_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "g string, v bigint")
    assert bin_quantiles(bin_counts(empty, "v", ["g"]), ["g"], SHARES).count() == 0
    nulls = spark.createDataFrame([("a", None), ("b", 3), ("b", None)], "g string, v bigint")
    assert [(r.g, r.n, r.p50) for r in bin_quantiles(bin_counts(nulls, "v", ["g"]), ["g"], SHARES).collect()] == [("b", 1, 3)]


def test_bins_of_the_widest_values_are_few(spark):
    assert bin_counts(spark.range(1).select(F.lit(2**63 - 1).alias("v")), "v", []).first()["bin"] < 2_200


@pytest.fixture
def drops(tmp_path):
    folder = tmp_path / "OSHP"
    folder.mkdir()
    (folder / "OSHP_20260101_000000.csv").write_text("TrnspCode;TrnspName;WebSite\nT1;One;w1\nT2;Two\nT3;Three;w3;more\n;;\n")
    (folder / "OSHP_20260201_000000.csv").write_text('TrnspCode;TrnspName;WebSite\nT4;"Four; Ltd";w4\nT5\n')
    return str(tmp_path)


def test_malformed_lines_are_kept_apart_with_their_file(spark, drops):
    checked = bronze.read_checked(spark, "OSHP", drops)
    good = sorted((r.TrnspCode or "", r.TrnspName) for r in bronze.well_formed(checked).collect())
    assert good == [("", None), ("T1", "One"), ("T4", "Four; Ltd")]
    bad = sorted((r.source_file.rsplit("_", 2)[-2], r.line, r.fields) for r in bronze.malformed_rows(checked).collect())
    assert bad == [("20260101", "T2;Two", 2), ("20260101", "T3;Three;w3;more", 4), ("20260201", "T5", 1)]
    # Counting alone reads no other column.
    assert bronze.malformed_rows(checked).count() == 3 and bronze.well_formed(checked).count() == 3
    assert bronze.well_formed(checked).columns == bronze.read_bronze(spark, "OSHP", drops).columns


def test_malformed_lines_of_a_window_and_of_no_file(spark, drops):
    recent = bronze.read_checked(spark, "OSHP", drops, since="2026-01-15 00:00:00")
    assert [r.line for r in bronze.malformed_rows(recent).collect()] == ["T5"]
    none = bronze.read_checked(spark, "OUSR", drops, optional=True)
    assert none.count() == 0 and bronze.malformed_rows(none).count() == 0 and bronze.well_formed(none).columns == ["USER_CODE", "U_NAME", "Department", "Branch"]
