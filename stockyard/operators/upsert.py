"""Row-level upserts as joins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.operators.dedup import require_unique
from stockyard.operators.keys import assign_surrogate_keys, highest_key
from stockyard.operators.skew import same_key

GUARDS = ("hash", "always", "insert_only")


def _may_update(guard: str, hash_column: str) -> Column:
    if guard == "always":
        return F.lit(True)
    if guard == "insert_only":
        return F.lit(False)
    # A NULL stored hash is refreshed; a NULL source hash compares as unknown and is not.
    return F.coalesce(F.col(f"t.{hash_column}").isNull() | (F.col(f"t.{hash_column}") != F.col(f"s.{hash_column}")),
                      F.lit(False))


def _cells(target: DataFrame, source_columns: list[str]) -> list[str]:
    """Each target column: the source's value where ``__take``, else the stored one."""
    return [f"CAST(if(__take, s.`{f.name}`, t.`{f.name}`) AS {f.dataType.simpleString()}) AS `{f.name}`"
            if f.name in source_columns else f"t.`{f.name}`" for f in target.schema]


def upsert(target: DataFrame, source: DataFrame, keys: list[str], guard: str = "hash",
           hash_column: str = "row_hash", source_unique: bool = False) -> DataFrame:
    """``target`` after the source: matched rows updated as ``guard`` allows, new rows added.

    ``hash`` updates where the stored hash is NULL or differs, ``always`` updates every match,
    ``insert_only`` none. Nothing is deleted. Target columns the source lacks are kept on
    update and NULL on insert. A repeated source key fails the job unless the caller states
    ``source_unique``. Both sides are unique on the key, so no key is hot in this join.
    """
    if guard not in GUARDS:
        raise ValueError(f"guard must be one of {GUARDS}")
    if not source_unique:
        source = require_unique(source, keys)
    if guard == "insert_only":
        missing = source.alias("s").join(target.select(*keys).alias("t"), same_key("s", "t", keys), "left_anti")
        return target.unionByName(missing.select([F.col(c) for c in target.columns if c in source.columns]),
                                  allowMissingColumns=True)

    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    take = F.col("t.__t").isNull() | (F.col("s.__s").isNotNull() & _may_update(guard, hash_column))
    joined = t.join(s, same_key("t", "s", keys), "full_outer").withColumn("__take", take)
    return joined.selectExpr(*_cells(target, source.columns))


def upsert_numbered(target: DataFrame, source: DataFrame, keys: list[str], sk: str, guard: str = "hash",
                    hash_column: str = "row_hash", source_unique: bool = False) -> DataFrame:
    """``upsert`` into a table with a surrogate key: new rows are numbered above the highest
    key in use, in key order; matched rows keep theirs."""
    if not source_unique:
        source = require_unique(source, keys)
    layout = [c for c in target.columns if c != sk]
    source = source.select([F.col(c).cast(target.schema[c].dataType).alias(c) for c in layout])
    matched = F.col(f"s.{keys[0]}").isNotNull()
    updated = target.alias("t").join(source.alias("s"), same_key("t", "s", keys), "left")
    updated = updated.withColumn("__take", matched & _may_update(guard, hash_column)).selectExpr(*_cells(target, layout))
    fresh = source.alias("s").join(target.select(*keys).alias("t"), same_key("s", "t", keys), "left_anti")
    numbered = assign_surrogate_keys(fresh, sk, keys, highest_key(target, sk))
    return updated.unionByName(numbered)


def changed_rows(target: DataFrame, source: DataFrame, keys: list[str], target_hash: str = "row_hash",
                 source_hash: str = "row_hash") -> DataFrame:
    """Source rows whose key is new to ``target`` or whose hash differs."""
    t = target.select(*keys, F.col(target_hash).alias("__hash"), F.lit(True).alias("__t")).alias("t")
    s = source.alias("s")
    new_or_changed = F.col("t.__t").isNull() | (F.col("t.__hash") != F.col(f"s.{source_hash}"))
    return s.join(t, same_key("s", "t", keys), "left").where(new_or_changed).select("s.*")
