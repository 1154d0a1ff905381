"""Service metrics on the picklist fact. Picklists not yet separated have a NULL time and
count in no average."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.operators.quantiles import bin_counts, bin_quantiles, merge_bins


def _whole(c: Column) -> Column:
    return F.round(c).cast("bigint")


def separation_times(fact: DataFrame, by: list[str]) -> DataFrame:
    """Average, median and 90th percentile of the separation seconds.

    Percentiles are exact; their map-side buffers hold counts per distinct second, so a
    group's size does not matter, only its spread.
    """
    s = F.col("sla_segundos")
    return fact.where(s.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("picklists"),
        F.avg(s).alias("avg_seconds"),
        _whole(F.percentile(s, F.lit(0.5))).alias("p50_seconds"),
        _whole(F.percentile(s, F.lit(0.9))).alias("p90_seconds"),
    )


def separation_bins(fact: DataFrame) -> DataFrame:
    """``Filial, day, sign, bin, n``: the separation seconds of each branch and day as bins, to be stored and added up."""
    return bin_counts(fact.withColumn("day", F.col("DataPickList").cast("date")), "sla_segundos", ["Filial", "day"])


def separation_rollup(bins: DataFrame) -> DataFrame:
    """``level, Filial, period, picklists, p50_seconds, p90_seconds`` of branches by month, branches and months, from stored ``separation_bins`` alone.

    A month is its first day; a level without branch or period has NULL there.
    """
    none, month = F.lit(None), F.trunc("day", "month")
    monthly = merge_bins(bins, ["Filial", month.alias("period")])
    levels = {
        "branch and month": monthly,
        "branch": merge_bins(monthly, ["Filial", none.cast("date").alias("period")]),
        "month": merge_bins(monthly, [none.cast("string").alias("Filial"), "period"]),
    }
    every = None
    for level, part in levels.items():
        part = part.select(F.lit(level).alias("level"), "Filial", "period", "sign", "bin", "n")
        every = part if every is None else every.unionByName(part)
    return bin_quantiles(every, ["level", "Filial", "period"], {"p50_seconds": 0.5, "p90_seconds": 0.9}).withColumnRenamed("n", "picklists")


def breach_rate(fact: DataFrame, target_seconds: int, by: list[str]) -> DataFrame:
    """Share of separated picklists slower than ``target_seconds``."""
    s = F.col("sla_segundos")
    late = F.count_if(s > target_seconds)
    return fact.where(s.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("picklists"), late.alias("late"), (late / F.count("*")).alias("breach_rate"))


def operator_productivity(fact: DataFrame, lines: DataFrame) -> DataFrame:
    """Picklists, pieces and distinct items per operator and day.

    Lines are reduced to one row per picklist and item before they meet the fact. Picklists and pieces are
    added up from one row per picklist and items from one row per item, so nothing is counted distinct over expanded rows.
    """
    work = fact.where(F.col("IdSeparador").isNotNull() & F.col("EmSeparacao").isNotNull()).select(
        "CodPickList", F.col("IdSeparador").alias("operator"), F.col("EmSeparacao").cast("date").alias("day"))
    items = lines.groupBy("pick_list_id", "item_code").agg(F.sum("pick_quantity").alias("pieces"))
    joined = work.join(items, F.col("CodPickList") == F.col("pick_list_id"), "left")
    by_item = joined.groupBy("operator", "day", "item_code").agg(F.sum("pieces").alias("pieces"))
    moved = by_item.groupBy("operator", "day").agg(
        F.coalesce(F.sum("pieces"), F.lit(0)).cast("decimal(18,2)").alias("pieces"), F.count("item_code").alias("items"))
    done = work.groupBy("operator", "day", "CodPickList").agg(F.lit(1).alias("one")).groupBy("operator", "day").agg(F.count("*").alias("picklists"))
    return done.join(moved, ["operator", "day"]).select("operator", "day", "picklists", "pieces", "items")


AGE_BANDS = ((1, "0-1"), (7, "2-7"), (30, "8-30"))
OLDEST_BAND = "31+"


def backlog(fact: DataFrame, as_of: str | Column) -> DataFrame:
    """Open picklists (neither cancelled nor separated nor dispatched) per branch and age in days."""
    day = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    age = F.date_diff(day, F.col("DataPickList").cast("date"))
    band = F.lit(OLDEST_BAND)
    for limit, name in reversed(AGE_BANDS):
        band = F.when(age <= limit, name).otherwise(band)
    is_open = (F.col("Cancelado") != "Y") & F.col("ProntoParaConferencia").isNull() & F.col("Saida").isNull()
    return fact.where(is_open).groupBy("Filial", band.alias("age_band")).agg(
        F.count("*").alias("picklists"), F.sum("QtdPecas").cast("decimal(18,2)").alias("pieces"))
