import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.functions import lookups, text
from stockyard.functions.calendar import calendar
from stockyard.functions.hashing import row_hash, strict_row_hash

T = dt.datetime


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("given, formats, want", [
    ("2026-01-05", (V.TIMESTAMP_FORMAT,), None),
    ("05/01/2026 10:00:00", (V.TIMESTAMP_FORMAT,), None),
    ("2026-01-05", (V.DATE_FORMAT,), T(2026, 1, 5)),
    ("2026-01-05 10:20:30", (V.TIMESTAMP_FORMAT, V.DATE_FORMAT), T(2026, 1, 5, 10, 20, 30)),
    ("2026-01-05", (V.TIMESTAMP_FORMAT, V.DATE_FORMAT), T(2026, 1, 5)),
    ("05/01/2026 10:20:30", (V.TIMESTAMP_FORMAT, V.BRAZILIAN_TIMESTAMP_FORMAT), T(2026, 1, 5, 10, 20, 30)),
    ("2026-02-30", (V.DATE_FORMAT,), None),
    ("2026-01-05 24:00:00", (V.TIMESTAMP_FORMAT,), None),
    ("2026-01-05 10:20:30\n", (V.TIMESTAMP_FORMAT,), None),
    (" 2026-01-05", (V.DATE_FORMAT,), None),
    ("2026-1-5", (V.DATE_FORMAT,), None),
    ("2026-01-05T10:20:30", (V.TIMESTAMP_FORMAT,), None),
    ("20260105", ("yyyyMMdd",), T(2026, 1, 5)),
    ("05 jan. 2026", ("dd MMM yyyy",), None),
    ("05 Jan 2026", ("dd MMM yyyy",), T(2026, 1, 5)),
    ("", (V.DATE_FORMAT,), None),
    (None, (V.DATE_FORMAT,), None),
])
def test_parse_ts(spark, given, formats, want):
    assert value(spark, text.parse_ts(F.lit(given).cast("string"), *formats)) == want


@pytest.mark.parametrize("given", ["2026-01-05 10:20:30", "2026-01-05", "9999-12-31 23:59:59", "2024-02-29 00:00:00", "2023-02-29 00:00:00",
                                   "2026-13-01 00:00:00", "2026-01-05 10:60:00", "2026-01-05 10:00:60", "2026-01-05 1:00:00", "0001-01-01 00:00:00",
                                   "2026-01-05 10:20:30 ", "x026-01-05 10:20:30"])
@pytest.mark.parametrize("fmt", [V.TIMESTAMP_FORMAT, V.DATE_FORMAT])
def test_shape_parsing_agrees_with_the_pattern_parser(spark, given, fmt):
    by_pattern = F.try_to_timestamp(F.lit(given), F.lit(fmt)).cast("timestamp_ntz")
    assert value(spark, text.parse_ts(F.lit(given), fmt)) == value(spark, by_pattern)


@pytest.mark.parametrize("given, want", [("12,50", Decimal("12.50")), ("12.5", Decimal("12.50")), ("n/a", None), ("1.234,5", None), (None, None)])
def test_repair_decimal(spark, given, want):
    assert value(spark, text.repair_decimal(F.lit(given).cast("string"), 18, 2)) == want


def test_strict_decimal_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("n/a",)], "a string").select(text.repair_decimal(F.col("a"), 18, 2, strict=True)).collect()


@pytest.mark.parametrize("given, want", [("F01", 1), ("F000123", 123), ("none", None), ("", None), ("99999999999", None), (None, None)])
def test_extract_code(spark, given, want):
    assert value(spark, text.extract_code(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize("code, center, size", [
    (1, "9301", "Grande"), (2, "Ajustar", "Média"), (9, "9005", "Grande"), (10, "Ajustar", "Média"), (12, "9201", "Pequena"),
    (16, "Ajustar", "Média"), (18, "9305", "Pequena"), (22, "9103", "Pequena"), (25, "9205", "Média"), (26, "Ajustar", "Média"), (None, "Ajustar", "Média")])
def test_branch_codes(spark, code, center, size):
    c = F.lit(code).cast("int")
    assert (value(spark, lookups.cost_center_of(c)), value(spark, lookups.branch_size_of(c))) == (center, size)


@pytest.mark.parametrize("state, who", [("AC", "Roberto Carlos"), ("DF", "Mariana Silva"), ("SP", "Thiago Mendes"), ("SC", "Beatriz Souza"),
                                        ("XX", "Não Atribuído"), (None, "Não Atribuído")])
def test_supervisor(spark, state, who):
    assert value(spark, lookups.supervisor_of(F.lit(state).cast("string"))) == who


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 4018
    sunday = days.where("data = DATE'2026-01-04'").first()
    assert (sunday.data_sk, sunday.dia_semana, sunday.nome_dia, sunday.nome_mes, sunday.mes_abrev, sunday.trimestre) == (20260104, 7, "domingo", "janeiro", "jan", 1)


def test_hash_text_rules(spark, rows):
    df = rows("a STRING, b STRING, n DECIMAL(18,3), t TIMESTAMP_NTZ", ("x", None, None, None), ("x", "", "0", None), ("x||", "", "0", None))
    same, also, other = [r[0] for r in df.select(row_hash(df, ["a", "b", "n", "t"])).collect()]
    assert same == also != other
    assert same == spark.sql("SELECT sha2('x||||0.000||', 256)").first()[0]
    df = rows("a STRING, b STRING", ("a||b", "c"), ("a", "b||c"), ("a", None), ("a", ""))
    plain = [r[0] for r in df.select(row_hash(df, ["a", "b"])).collect()]
    strict = [r[0] for r in df.select(strict_row_hash(df, ["a", "b"])).collect()]
    assert plain[0] == plain[1] and plain[2] == plain[3]
    assert len(set(strict)) == 4
    skipped = df.select(row_hash(df, ["a", "b"], unfilled=("b",))).collect()[2][0]
    assert skipped == spark.sql("SELECT sha2('a', 256)").first()[0]
