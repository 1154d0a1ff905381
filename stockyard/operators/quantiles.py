"""Mergeable quantiles: counts per bin of a logarithmic scale, small enough to store by day and add up to any coarser level.

A bin holds the values of one factor ``(1 + error) / (1 - error)``; every value in it is within ``error`` of the bin's middle, relative to the value.
Bins of two groups are merged by adding their counts, so a month's quantiles come from its days' stored bins and the fact is not read again.
The number of bins of a group depends on the span of its values only: at most about 2,100 positive ones for a bigint at one per cent.

Defined results: NULL values count nowhere; zero has a bin of its own; negative values mirror the positive ones; a group without values has no row.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ERROR = 0.01


def _growth(error: float) -> float:
    return math.log((1 + error) / (1 - error))


def bin_counts(rows: DataFrame, value: str, by: list[str], error: float = ERROR) -> DataFrame:
    """``by, sign, bin, n``: how many values of each group fall into each bin. Counted map-side, so no group meets in one task before it is small."""
    v = F.col(value)
    size = F.abs(v.cast("double"))
    place = F.when(v == 0, 0).otherwise(F.ceil(F.ln(size) / F.lit(_growth(error)))).cast("bigint")
    return rows.where(v.isNotNull()).groupBy(*by, F.signum(v.cast("double")).cast("int").alias("sign"), place.alias("bin")).agg(F.count("*").alias("n"))


def merge_bins(bins: DataFrame, by: list[Column | str]) -> DataFrame:
    """Bins of a coarser level from those of finer ones."""
    return bins.groupBy(*by, "sign", "bin").agg(F.sum("n").alias("n"))


def bin_quantiles(bins: DataFrame, by: list[str], shares: dict[str, float], error: float = ERROR) -> DataFrame:
    """``by, n`` and per entry of ``shares`` the middle of the bin that holds the value of that rank (the lower one of two), rounded to a whole number.

    The windows run over a group's bins, whose number the span of the values bounds, not over its rows.
    """
    middle = F.col("sign") * F.lit(2.0) * F.exp(F.col("bin") * F.lit(_growth(error))) / F.lit(1 + math.exp(_growth(error)))
    ordered = Window.partitionBy(*by).orderBy("sign", F.col("sign") * F.col("bin"))
    summed = bins.withColumn("__upto", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    sized = summed.withColumn("__all", F.sum("n").over(Window.partitionBy(*by))).withColumn("__middle", middle)
    # The first bin whose values reach beyond the rank: bins come in order, so it is the one of the lowest middle.
    found = [F.round(F.min(F.when(F.col("__upto") > F.floor(F.lit(q) * (F.col("__all") - 1)), F.col("__middle")))).cast("bigint").alias(name) for name, q in shares.items()]
    return sized.groupBy(*by).agg(F.max("__all").alias("n"), *found)
