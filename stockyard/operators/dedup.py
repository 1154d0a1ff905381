"""Keep the latest version of each key."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


@dataclass(frozen=True)
class Ranking:
    """How rows of several loads are ranked against those a table stores, by columns of which it does not store all."""

    table: str  # holds the keys and the ``beside`` columns of the stored rows
    partition: dict[str, Column]  # its directory column, decided by the key
    latest: list[str]  # as in ``keep_latest``
    beside: list[str]  # those of the staged columns that the table lacks
    stage: Callable[[DataFrame], DataFrame]  # raw rows to the latest staged row per key
    restage: Callable[[DataFrame], DataFrame]  # stored rows with their ``beside`` columns to staged rows
    finish: Callable[[DataFrame], DataFrame]  # staged rows to rows of the table
    rows: Callable[[DataFrame], DataFrame] | None = None  # raw rows to staged rows, row by row, for streams that keep the latest as state


def keep_latest(df: DataFrame, keys: list[str], latest: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``latest`` (NULLs lowest), then by the remaining columns.

    The tie rule makes the survivor independent of input order and partitioning. Ranking
    with ``= 1`` lets Spark keep one row per key in each map task before the shuffle, so a
    key holding a third of all rows sends at most one row per map task.
    """
    latest = latest or []
    ties = [c for c in df.columns if c not in keys and c not in latest]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in latest + ties])
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, failing at run time if a key repeats.

    Only two rows per key leave a map task (the same ranking limit as above), and the
    key partitioning is the one the following join needs.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    ranked = df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= 2)
    all_set = F.lit(True)
    for k in keys:
        all_set = all_set & F.col(k).isNotNull()
    message = F.concat(F.lit("repeated source key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    checked = F.when(all_set & (F.col(_RANK) > 1), F.raise_error(message).cast("int")).otherwise(F.col(_RANK))
    # NULL keys never match a target, so they cannot collide; the filter also keeps the check in the plan.
    return ranked.withColumn(_RANK, checked).where(F.col(_RANK) >= 1).drop(_RANK)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
