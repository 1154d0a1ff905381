"""Downtime records: parse them, total them, and take the affected picklists out."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.functions.text import parse_ts
from stockyard.operators.intervals import merged_intervals, overlapping


def _at(day: str, hour: str, minute: str) -> Column:
    padded = [F.lpad(F.trim(F.col(c)), 2, "0") for c in (hour, minute)]
    return parse_ts(F.concat(F.col(day), F.lit(" "), padded[0], F.lit(":"), padded[1], F.lit(":00")))


def stage_downtime(raw: DataFrame) -> DataFrame:
    """Raw downtime text to branch code, interval and minutes."""
    staged = raw.select(
        F.trim(F.element_at(F.split("Filial", " - ", 2), 1)).alias("branch_id"),
        F.trim("CodPickList").alias("pick_list_id"),
        _at("DataParada", "HoraParada", "MinutoParada").alias("stopped_at"),
        _at("DataRetorno", "HoraRetorno", "MinutoRetorno").alias("resumed_at"),
        F.col("Motivo").alias("reason"),
        F.lower("Email").alias("reported_by"),
    )
    seconds = F.unix_timestamp("resumed_at") - F.unix_timestamp("stopped_at")
    return staged.withColumn("downtime_minutes", (seconds / 60).cast("bigint"))


def downtime_by_reason(downtime: DataFrame) -> DataFrame:
    return downtime.groupBy("reason").agg(
        F.count("*").alias("stops"),
        F.count_distinct("branch_id").alias("branches"),
        F.sum("downtime_minutes").alias("total_minutes"),
        F.max("downtime_minutes").alias("longest_minutes"),
    )


def _whole_branch(downtime: DataFrame) -> DataFrame:
    return downtime.where(F.col("pick_list_id") == V.WHOLE_BRANCH_CODE).select("branch_id", "stopped_at", "resumed_at")


def branch_stops(downtime: DataFrame) -> DataFrame:
    """Disjoint times in which a whole branch was down, with the number of records behind each."""
    return merged_intervals(_whole_branch(downtime), ["branch_id"], "stopped_at", "resumed_at").withColumnRenamed("merged", "records")


def exclude_downtime(fact: DataFrame, downtime: DataFrame) -> DataFrame:
    """Fact rows neither named by a downtime record nor separated while their branch was down.

    Separations and stops of a branch are put in order of time, a row each, and a running maximum finds the overlaps; see ``intervals``.
    """
    named = downtime.where(F.col("pick_list_id") != V.WHOLE_BRANCH_CODE).select(F.col("pick_list_id").alias("__hit"))
    worked = fact.select(F.col("CodPickList").alias("__hit"), F.col("Filial").alias("branch_id"), F.col("EmSeparacao").alias("__begun"), F.col("ProntoParaConferencia").alias("__done"))
    stopped = overlapping(worked, _whole_branch(downtime), ["branch_id"], "__begun", "__done", "stopped_at", "resumed_at").select("__hit")
    hits = named.unionByName(stopped).distinct()
    return fact.join(hits, F.col("CodPickList") == F.col("__hit"), "left_anti")
