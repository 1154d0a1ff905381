"""Left lookups that survive hot keys."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKETS = 1 << 16
_PIECE, _PIECE_RIGHT, _HOT, _PIECES = "__piece", "__piece_right", "__hot", "__pieces"


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find_hot(df: DataFrame, keys: list[str], tasks: int | None = None) -> dict[str, dict]:
    """For each column of ``keys``, the values that hold more than one task's fair share of the rows, and how many shares.

    The share is ``rows / tasks`` (``tasks``: the shuffle partitions), so the rule is the same at every size: at most ``tasks`` values
    of a column are hot and their pieces sum to at most twice ``tasks``, which bounds what is collected and later broadcast.
    A first narrow pass per column counts hashes of the values, dealt over ``_BUCKETS`` numbers, so that little leaves a map task however many values there are.
    A hot value makes its bucket hot, so a second pass counts only the values of hot buckets; without any there is none.
    NULL is not listed: ``lookup`` always spreads it.
    """
    tasks = tasks or _tasks(df)
    bucket = lambda k: F.pmod(F.xxhash64(k), F.lit(_BUCKETS)).cast("int")
    counted = reduce(DataFrame.unionByName, [
        df.groupBy(bucket(k).alias("bucket")).agg(F.count("*").alias("rows")).select(F.lit(n).alias("role"), "bucket", "rows") for n, k in enumerate(keys)])
    total = counted.groupBy(F.col("role").alias("of")).agg(F.sum("rows").alias("total"))
    more_than_a_share = F.ceil(F.col("rows") * tasks / F.col("total")).cast("int")
    full = counted.join(F.broadcast(total), F.col("role") == F.col("of")).where(more_than_a_share > 1).select("role", "bucket", "total").collect()
    hot = {k: {} for k in keys}
    for n, k in enumerate(keys):
        buckets = [r.bucket for r in full if r.role == n]
        if not buckets:
            continue
        rows = next(r.total for r in full if r.role == n)
        values = df.where(F.col(k).isNotNull() & bucket(k).isin(buckets)).groupBy(F.col(k).alias("value")).agg(F.count("*").alias("rows"))
        pieces = F.ceil(F.col("rows") * tasks / F.lit(rows)).cast("int").alias("pieces")
        hot[k] = {r.value: r.pieces for r in values.select("value", pieces).where(F.col("pieces") > 1).collect()}
    return hot


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
           also: Column | None = None, hot: dict | None = None, spread: str | None = None) -> DataFrame:
    """Left join of ``left`` to its few matches in ``right``; every left row stays.

    Catalyst broadcasts ``right`` by itself while its estimated or measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. Rows of a ``hot`` key (see
    ``find_hot``) are dealt over as many pieces as it holds fair shares, by ``spread``, and its matches are
    copied to each piece; NULL keys, which match nothing, are dealt over all tasks. Other keys are one piece.
    """
    hot = hot or {}
    kind = left.schema[left_key].dataType.simpleString()
    marked = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), f"{_HOT} {kind}, {_PIECES} int"))

    def cut(df: DataFrame, key: str) -> DataFrame:
        return df.join(marked, F.col(key) == F.col(_HOT), "left") if hot else df.withColumn(_PIECES, F.lit(None).cast("int"))

    # NULL keys count as pieces of their own, so that they never fill one task.
    pieces = F.when(F.col(left_key).isNull(), F.lit(_tasks(left))).otherwise(F.coalesce(_PIECES, F.lit(1)))
    dealt = F.pmod(F.xxhash64(F.col(spread or left_key)), pieces).cast("int")
    cut_left = cut(left, left_key).withColumn(_PIECE, dealt).drop(_HOT, _PIECES)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(_PIECES, F.lit(1)) - 1))
    cut_right = cut(right, right_key).withColumn(_PIECE_RIGHT, copies).drop(_HOT, _PIECES)
    match = (F.col(left_key) == F.col(right_key)) & (F.col(_PIECE) == F.col(_PIECE_RIGHT))
    return cut_left.join(cut_right, match if also is None else match & also, "left").drop(_PIECE, _PIECE_RIGHT)


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Equality of ``keys`` between two aliased inputs."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])
