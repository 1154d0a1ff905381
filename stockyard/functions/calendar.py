"""Calendar dimension."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.functions.lookups import name_at


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar columns for one ``data`` DATE column."""
    d = F.col("data")
    sk, month, weekday = F.date_format(d, "yyyyMMdd").cast("int"), F.month(d), F.weekday(d) + 1
    return days.select(
        sk.alias("data_sk"), sk.alias("date_id"), d,
        F.year(d).alias("ano"), F.quarter(d).alias("trimestre"), month.alias("mes"), F.day(d).alias("dia"),
        weekday.alias("dia_semana"),
        name_at(V.MONTH_NAMES, month).alias("nome_mes"),
        name_at(V.MONTH_ABBREVIATIONS, month).alias("mes_abrev"),
        name_at(V.WEEKDAY_NAMES, weekday).alias("nome_dia"),
    )


def _each_day(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("data"))


def calendar(spark: SparkSession, start: str = V.CALENDAR_START, end: str = V.CALENDAR_END) -> DataFrame:
    """One row per day of a fixed range."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last"))
    return describe_days(_each_day(bounds))


def calendar_spanning(df: DataFrame, date_column: str) -> DataFrame:
    """One row per day between the first and last date found in ``df``."""
    d = F.col(date_column).cast("date")
    return describe_days(_each_day(df.agg(F.min(d).alias("first"), F.max(d).alias("last"))))
