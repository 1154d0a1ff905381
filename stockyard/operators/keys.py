"""Surrogate keys and unknown members."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.sources.shared_dir import at_rest


def highest_key(df: DataFrame, sk: str) -> int:
    """Largest key given out so far; 0 for an empty table."""
    return df.agg(F.max(sk)).first()[0] or 0


def assign_surrogate_keys(df: DataFrame, sk: str, order: list[str], above: int = 0) -> DataFrame:
    """Number rows ``above + 1, above + 2, …`` in the order of ``order``.

    No single-task sort: rows are range-partitioned on the whole order (a hot natural key is
    split by what follows it), sorted within partitions and written to the shared folder, so
    a retry sees the same rows at the same positions. A row's number is its position in its
    file plus the rows of the files before; only one count per file reaches the driver.
    """
    spark = df.sparkSession
    # A unique order needs no tie rule; otherwise the other columns settle it.
    everything = order + [c for c in df.columns if c not in order]
    fixed = at_rest(df.repartitionByRange(*order).sortWithinPartitions(*everything))
    placed = fixed.select("*", F.col("_metadata.file_name").alias("__of"), F.col("_metadata.row_index").alias("__at"))
    counts = {r["__of"]: r["count"] for r in placed.groupBy("__of").count().collect()}
    before, starts = above, []
    for name in sorted(counts, key=_place):
        starts.append((name, before))
        before += counts[name]
    if not starts:
        return fixed.select(F.lit(None).cast("bigint").alias(sk), "*")
    offsets = spark.createDataFrame(starts, "__file string, __before bigint")
    return (
        placed.join(F.broadcast(offsets), F.col("__of") == F.col("__file"))
        .select((F.col("__before") + F.col("__at") + 1).alias(sk), *[F.col(c) for c in df.columns])
    )


def _place(name: str) -> tuple[int, str]:
    """Order of Spark's part files: ``part-<task>-<write>-c<file of the task>``."""
    return int(name.split("-")[1]), name


def literal_row(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One row with the layout of ``df``; columns not named are NULL."""
    cells = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]
    return df.sparkSession.range(1).select(*cells)


def with_member(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """``df`` plus one literal member unless its key is there already."""
    row = literal_row(df, values)
    there = df.select(F.col(key).alias("__key"))
    return df.unionByName(row.join(there, F.col(key) == F.col("__key"), "left_anti"))
