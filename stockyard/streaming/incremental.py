"""Incremental loading: a look-back window for extracts, and upserts fed by a file stream."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard import fixed_values as V
from stockyard.operators.dedup import Ranking, keep_latest, require_unique
from stockyard.operators.upsert import upsert
from stockyard.sources.shared_dir import staged
from stockyard.sources.tables import merge_touched, publish, read_table


def incremental_window(df: DataFrame, changed_at: str, as_of: str | Column, days: int = V.INCREMENTAL_WINDOW_DAYS) -> DataFrame:
    """Rows changed in the ``days`` days up to ``as_of``."""
    end = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")
    return df.where((F.col(changed_at) >= F.timestamp_add("DAY", F.lit(-days), end)) & (F.col(changed_at) <= end))


def upsert_stream(raw: DataFrame, clean: Callable[[DataFrame], DataFrame], lake: str, table: str, keys: list[str],
                  checkpoint: str, partition: dict[str, Column] | None = None, ranking: Ranking | None = None) -> None:
    """Drain a raw file stream into ``lake``: each micro-batch is cleaned and upserted.

    With ``partition`` (one directory column) a batch rewrites only the partitions it changes,
    otherwise the table gets a new version per batch. A batch replayed after a failure meets its own rows and the hash guard leaves them alone,
    so the sink is idempotent. Files are taken in the order they arrived. Without ``ranking`` the last one wins;
    with it a stored row gives way only to one that ranks higher, so late files change nothing they should not.
    A stored row without ranking columns (loaded otherwise) ranks lowest.
    """
    def store(source: DataFrame, name: str, by: dict[str, Column] | None, latest: bool = False) -> None:
        if by:
            (part, value), = by.items()
            merge_touched(source if latest else require_unique(source, keys), lake, name, keys, part, value, stored=latest)
        else:
            publish(upsert(read_table(source.sparkSession, lake, name), source, keys, source_unique=latest), lake, name)

    def load(batch: DataFrame, _batch_id: int) -> None:
        if ranking is None:
            store(clean(batch), table, partition)
            return
        spark = batch.sparkSession
        with staged(spark) as stage:
            fresh, known = stage(ranking.stage(batch)), read_table(spark, lake, table)
            latest = fresh  # the highest of each key; nothing stored can rank higher before the first row is
            if known.take(1):
                known = known.join(fresh.select(*keys), keys, "left_semi")
                known = known.join(read_table(spark, lake, ranking.table).select(*keys, *ranking.beside), keys, "left")
                latest = stage(keep_latest(fresh.unionByName(ranking.restage(known)), keys, ranking.latest))
            # The rows first: a batch cut off in between is played again, and its rows still rank above what it stored.
            store(ranking.finish(latest), table, partition, latest=True)
            store(latest.select(*keys, *ranking.beside, F.xxhash64(*ranking.beside).cast("string").alias("row_hash")), ranking.table, ranking.partition, latest=True)

    query = raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def rank_stream(raw: DataFrame, lake: str, table: str, keys: list[str], checkpoint: str, partition: dict[str, Column], ranking: Ranking) -> None:
    """Drain a raw file stream into ``lake``; the highest-ranking row of each key is kept as state, not looked up in the table.

    The state is the aggregate of a streaming ``max`` over a key's rows in the order of ``keep_latest`` (NULLs lowest, ties by the remaining columns), over all
    runs from the same checkpoint. A batch hands on the rows of the keys it held; a row that did not change has the stored hash and is left alone, so late files change
    nothing they should not. Rows are reduced in each map task before they move. On a cluster give Spark its RocksDB
    state store. Rows that were stored without this stream have no state: load a table through one or the other.
    """
    staged = ranking.rows(raw)
    order = ranking.latest + [c for c in staged.columns if c not in keys and c not in ranking.latest]
    best = staged.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__best")).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order])

    def load(batch: DataFrame, _batch_id: int) -> None:
        (part, value), = partition.items()
        merge_touched(ranking.finish(batch), lake, table, keys, part, value)

    query = best.writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
