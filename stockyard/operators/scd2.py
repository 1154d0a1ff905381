"""Type 2 history: validity intervals, one current version per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.operators.keys import assign_surrogate_keys, highest_key
from stockyard.operators.upsert import upsert
from stockyard.sources.shared_dir import at_rest


def _time(text_or_column) -> Column:
    c = text_or_column if isinstance(text_or_column, Column) else F.lit(text_or_column)
    return c.cast("timestamp_ntz")


def late_rows(dim: DataFrame, source: DataFrame, nk: str, source_hash: str = "source_hash", ts: str = "src_ts") -> DataFrame:
    """Changed source rows that are not newer than the version they would close."""
    current = dim.where("is_current").select(F.col(nk).alias("__nk"), F.col("row_hash").alias("__hash"),
                                             F.col("effective_start").alias("__start"))
    is_late = (F.col(nk) == F.col("__nk")) & (F.col("__hash") != F.col(source_hash)) & (F.col(ts) <= F.col("__start"))
    return source.join(current, is_late, "left_semi")


def apply_changes(dim: DataFrame, source: DataFrame, nk: str, sk: str, load_ts: str,
                  source_hash: str = "source_hash", ts: str = "src_ts", late: str = "accept") -> DataFrame:
    """``dim`` after one source snapshot (unique on ``nk``).

    Current versions whose hash differs are closed at the source time; keys left without a
    current version get one from the source, numbered above the highest key in use. Both
    sides use the same time, ``load_ts`` standing in for a missing one, and closing and
    opening are one result: there is no moment without a current version. Closed history
    is passed through without a shuffle. A NULL stored hash is neither closed nor reopened.
    The source is read once: its changed rows, stored, are what closes, opens and is numbered.
    ``late="reject"`` leaves out source rows that ``late_rows`` reports.
    """
    if late not in ("accept", "reject"):
        raise ValueError("late must be 'accept' or 'reject'")
    is_current = F.coalesce(F.col("is_current"), F.lit(False))
    history, current = dim.where(~is_current), dim.where(is_current)
    changes = at_rest(_changes(current, source, nk, load_ts, source_hash, ts, late))

    closing = changes.select(F.col(nk).alias("__nk"), F.col(source_hash).alias("__hash"), "__at")
    differs = F.coalesce(F.col("row_hash") != F.col("__hash"), F.lit(False))
    closed = (
        current.join(closing, F.col(nk) == F.col("__nk"), "left")
        .withColumn("effective_end", F.when(differs, F.col("__at")).otherwise(F.col("effective_end")))
        .withColumn("is_current", ~differs)
        .select(*dim.columns)
    )
    opened = (
        changes.where("__opens")
        .withColumn("effective_start", F.col("__at"))
        .withColumn("effective_end", _time(V.OPEN_END))
        .withColumn("is_current", F.lit(True))
        .withColumn("row_hash", F.col(source_hash))
        .select([F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema if f.name != sk])
    )
    numbered = assign_surrogate_keys(opened, sk, [nk, "effective_start"], highest_key(dim, sk))
    return history.unionByName(closed).unionByName(numbered)


def _changes(current: DataFrame, source: DataFrame, nk: str, load_ts: str, source_hash: str, ts: str, late: str) -> DataFrame:
    """The source rows that close or open a version, with the time (``__at``) and whether they open one (``__opens``).

    One join of the source with the hashes of the current versions settles both, and whether a row is late; the rest of the source goes no further.
    """
    known = current.groupBy(F.col(nk).alias("__nk")).agg(
        F.collect_set("row_hash").alias("__hashes"), F.max("effective_start").alias("__start"), F.lit(True).alias("__there"))
    joined = source.join(known, F.col(nk) == F.col("__nk"), "left")
    there, hashed = F.col("__there").isNotNull(), F.col(source_hash).isNotNull()
    same = F.coalesce(F.array_contains("__hashes", F.col(source_hash)), F.lit(False))
    # A NULL hash on either side compares as unknown: it neither closes nor opens.
    unknown = ~hashed | (F.size("__hashes") == 0)
    opens = ~there | ~(unknown | same)
    closes = there & hashed & (F.size("__hashes") > same.cast("int"))
    kept = joined.withColumns({"__opens": opens, "__at": F.coalesce(F.col(ts), _time(load_ts))}).where(opens | closes)
    if late == "reject":
        kept = kept.where(~F.coalesce(closes & (F.col(ts) <= F.col("__start")), F.lit(False)))
    return kept.drop("__nk", "__hashes", "__start", "__there")


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def sync_history(copy: DataFrame, dim: DataFrame, sk: str, propagate_closure: bool = True) -> DataFrame:
    """``copy`` brought up to date with every version of ``dim``, matched on the surrogate key.

    Closing a version leaves its hash alone, so a plain hash guard never carries closures
    over. By default the guard also compares the validity end and the current flag;
    ``propagate_closure=False`` gives the plain guard.
    """
    if not propagate_closure:
        return upsert(copy, dim, [sk], source_unique=True)

    def guarded(df: DataFrame) -> DataFrame:
        state = F.concat_ws(V.HASH_SEPARATOR, "row_hash", F.col("effective_end").cast("string"), F.col("is_current").cast("string"))
        return df.withColumn("__state", F.when(F.col("row_hash").isNotNull(), state))

    return upsert(guarded(copy), guarded(dim), [sk], hash_column="__state", source_unique=True).drop("__state")
