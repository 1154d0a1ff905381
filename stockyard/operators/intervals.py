"""Time intervals per key: merged into disjoint ones, and tested for overlap, without a row per day.

Both operators order a key's rows within a day only. What earlier days hand on, their latest end, is one row per key and day, and only
these rows are ordered per key. So a key with a third of all rows is spread over its days, and an interval that ends in the year 9999 is one row like any other.
Intervals are half-open. Rows with a NULL key or bound, or that end no later than they start, take no part.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DAY = "__day"


def _same(keys: list[str], suffix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{k}{suffix}") for k in [*keys, _DAY]])


def _from_earlier_days(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the greatest ``value`` of the key's earlier days as ``name``."""
    by_day = rows.groupBy(*keys, _DAY).agg(F.max(value).alias("__most"))
    earlier = Window.partitionBy(*keys).orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    handed = by_day.select(*[F.col(k).alias(f"{k}__of") for k in [*keys, _DAY]], F.max("__most").over(earlier).alias(name))
    return rows.join(handed, _same(keys, "__of")).drop(*[f"{k}__of" for k in [*keys, _DAY]])


def _proper(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) & (F.col(start) < F.col(end)))


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Disjoint intervals of each key that cover the same time, with the number of rows merged: ``keys, start, end, merged``. Touching intervals become one."""
    rows = _proper(df, keys, start, end).select(*keys, F.col(start).alias("__s"), F.col(end).alias("__e"), F.col(start).cast("date").alias(_DAY))
    inside = Window.partitionBy(*keys, _DAY).orderBy("__s", "__e")
    before = F.greatest("__handed", F.max("__e").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    opened = _from_earlier_days(rows, keys, "__e", "__handed").withColumn("__before", before)
    # The start of a row that no earlier one reaches opens an interval; openings rise, so the last one is the greatest.
    opened = opened.withColumn("__opens", F.when(F.col("__before").isNull() | (F.col("__s") > F.col("__before")), F.col("__s"))).drop("__handed", "__before")
    placed = _from_earlier_days(opened, keys, "__opens", "__open")
    opening = F.coalesce(F.max("__opens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "__open")
    return placed.withColumn(start, opening).groupBy(*keys, start).agg(F.max("__e").alias(end), F.count("*").alias("merged"))


def overlapping(rows: DataFrame, intervals: DataFrame, keys: list[str], start: str, end: str, interval_start: str, interval_end: str) -> DataFrame:
    """The ``rows`` that overlap any of the ``intervals`` of the same key, each once.

    Of the intervals that start before a row ends, the one that ends last decides: the row overlaps one of them if and only if that one
    ends after the row starts. So a running maximum over both in order of time is enough, and no pairs are made.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__row")
    asked = _proper(rows, keys, start, end).select(*keys, F.col(end).alias("__at"), F.lit(0).alias("__kind"), F.col(start).alias("__from"), kept)
    nothing = F.lit(None)
    given = _proper(intervals, keys, interval_start, interval_end).select(
        *keys, F.col(interval_start).alias("__at"), F.lit(1).alias("__kind"), F.col(interval_end).alias("__until"))
    # At the same time rows come first: an interval that starts where a row ends does not overlap it.
    events = (asked.withColumn("__until", nothing.cast(given.schema["__until"].dataType))
              .unionByName(given, allowMissingColumns=True).withColumn(_DAY, F.col("__at").cast("date")))
    upto = Window.partitionBy(*keys, _DAY).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.greatest("__handed", F.max("__until").over(upto))
    timed = _from_earlier_days(events, keys, "__until", "__handed").withColumn("__latest", latest)
    return timed.where((F.col("__kind") == 0) & (F.col("__latest") > F.col("__from"))).select("__row.*")
