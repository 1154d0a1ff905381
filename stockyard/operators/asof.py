"""Point-in-time join of a fact to versioned dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.operators.skew import lookup


def asof_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, date: str, take: dict[str, str],
              hot: dict | None = None, spread: str | None = None) -> DataFrame:
    """Add to each fact row the ``take`` columns (dimension name -> new name) of the version
    valid on its day, NULL if none is.

    Validity is half-open at day grain: a change at 15:00 gives that whole day to the new
    version, and a version opened and closed within a day matches nothing. Only the columns
    needed travel, and versions no day can fall into are dropped before the join.
    """
    starts = F.col("effective_start").cast("date")
    ends = F.coalesce(F.col("effective_end"), F.lit(V.OPEN_END).cast("timestamp_ntz")).cast("date")
    versions = dim.select(F.col(dim_key).alias("__key"), starts.alias("__from"), ends.alias("__to"),
                          *[F.col(c).alias(name) for c, name in take.items()]).where("__from < __to")
    valid = (F.col(date) >= F.col("__from")) & (F.col(date) < F.col("__to"))
    joined = lookup(fact, versions, fact_key, "__key", also=valid, hot=hot, spread=spread)
    return joined.drop("__key", "__from", "__to")


def or_unknown(sk: str):
    """A missing key becomes the unknown member's."""
    return F.coalesce(F.col(sk), F.lit(V.UNKNOWN_SK).cast("bigint")).alias(sk)
