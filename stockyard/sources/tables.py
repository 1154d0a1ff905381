"""Lake tables as Parquet.

``publish`` writes a complete new version directory and never touches the one being read, so
a failed or repeated job leaves the last complete version in place; a version counts once
Spark's committer has put ``_SUCCESS`` into it. That suits dimensions. ``merge_touched`` is for
tables too big to rewrite: it replaces only the partitions in which a row changes.
"""

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.operators.keyfilter import may_match
from stockyard.operators.skew import same_key
from stockyard.operators.upsert import changed_rows, upsert
from stockyard.schemas import conform, empty, schema
from stockyard.sources.shared_dir import at_rest, staged


_PARTS = "parts"
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
#: A merge takes about so many commits; each holds so many rows at least. With more pairs of partitions between which rows move it takes one.
_COMMITS, _COMMIT_ROWS, _MOVES = 8, 1_000_000, 100_000


def _path(root: str, table: str) -> str:
    return f"{root}/{table.replace('.', '/')}"


def _folder(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    return sorted(n for n in numbers if fs.exists(_folder(spark, f"{path}/v={n}/_SUCCESS")[0]))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Latest complete version of ``layer.table``; empty before the first publish."""
    path = _path(root, table)
    parts, fs = _folder(spark, f"{path}/{_PARTS}")
    if fs.exists(parts):
        return conform(spark.read.schema(schema(table)).parquet(f"{path}/{_PARTS}"), table)
    versions = _versions(spark, path)
    if not versions:
        return empty(spark, table)
    latest = f"{path}/v={versions[-1]}"
    return conform(spark.read.schema(schema(table)).option("basePath", latest).parquet(latest), table)


def publish(df: DataFrame, root: str, table: str, partition_by: dict[str, Column] | None = None) -> DataFrame:
    """Write ``df`` as the next version of ``layer.table`` and return that version.

    ``partition_by`` maps directory names to their values; a name may be one of the table's
    columns. Rows are rebalanced by these values first, one shuffle, so that a directory gets
    few files while AQE splits a value holding very many rows.
    """
    spark = df.sparkSession
    path = _path(root, table)
    version = (_versions(spark, path) or [0])[-1] + 1
    out = conform(df, table)
    if partition_by:
        out = out.withColumns(partition_by).hint("rebalance", *partition_by)
    writer = out.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/v={version}")
    return read_table(spark, root, table)


def _read_parts(spark: SparkSession, path: str, table: str, part: str, names: list[str | None]) -> DataFrame:
    """Rows of the named partitions; no other directory is listed."""
    paths = [f"{path}/{part}={_NULL_PART if n is None else n}" for n in names]
    there = [p for p in paths if _folder(spark, p)[1].exists(_folder(spark, p)[0])]
    if not there:
        return empty(spark, table).withColumn(part, F.lit(None).cast("string"))
    read = spark.read.schema(schema(table)).option("basePath", path).parquet(*there)
    return conform(read, table, part).withColumn(part, F.col(part).cast("string"))


def _write_parts(rows: DataFrame, path: str, part: str, value: Column, replace: bool = False) -> None:
    """Write ``rows`` by partition, few files each; with ``replace`` in place of the partitions they fall into, which ``rows`` may be read from."""
    writer = rows.withColumn(part, value).hint("rebalance", part).write.option("compression", "zstd").partitionBy(part)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _same_keys(keys: list[str], null_too: bool = False) -> Column:
    pairs = [(F.col(k), F.col(f"__{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_too else x == y for x, y in pairs])


def _part_names(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(_NULL_PART))


def _count_by(df: DataFrame, part: Column) -> Counter:
    """Rows by partition."""
    return Counter({r.p: r["count"] for r in df.groupBy(part.alias("p")).count().collect()})


def _commits(rows: dict[str, int], moves: Iterable[tuple[str, str]] = ()) -> list[set[str]]:
    """The partitions, with their ``rows``, dealt in order over commits of about a ``_COMMITS``-th of all rows each, which few rows do not need.

    Partitions between which a row ``moves`` share a commit, so that it is not gone from one before it is in the other.
    """
    kin = {p: {p} for p in rows}
    for a, b in moves:
        if kin[a] is not kin[b]:
            few, many = sorted((kin[a], kin[b]), key=len)
            many |= few
            kin.update(dict.fromkeys(few, many))
    share, commits, held = max(sum(rows.values()) / _COMMITS, _COMMIT_ROWS), [], 0
    for p in sorted(rows):
        if kin[p] is None:
            continue
        own, n = kin[p], sum(rows[k] for k in kin[p])
        if not commits or held + n > share:
            commits.append(set())
            held = 0
        commits[-1] |= own
        held += n
        kin.update(dict.fromkeys(own))
    return commits


def in_turn(df: DataFrame, root: str, table: str, part: str, value: Column) -> Iterator[tuple[DataFrame, DataFrame]]:
    """``df`` and the stored rows of its partitions (``value``), both cut alike: the partitions of one commit (``_commits``) after the other."""
    spark, path = df.sparkSession, f"{_path(root, table)}/{_PARTS}"
    to, at = _part_names(value), _part_names(F.col(part))
    mine = _count_by(df, to)
    there = _read_parts(spark, path, table, part, [None if p == _NULL_PART else p for p in sorted(mine)])
    for names in _commits(mine + _count_by(there, at)):
        yield df.where(to.isin(names)), there.where(at.isin(names))


def merge_touched(source: DataFrame, root: str, table: str, keys: list[str], part: str, value: Column, by_key: bool = False, stored: bool = False) -> DataFrame:
    """The table after ``merge_changes``."""
    with staged(source.sparkSession) as keep:
        return merge_changes(source, root, table, keys, part, value, by_key, stored, keep)[0]


def merge_changes(source: DataFrame, root: str, table: str, keys: list[str], part: str, value: Column, by_key: bool = False,
                  stored: bool = False, keep: Callable[[DataFrame], DataFrame] = at_rest) -> tuple[DataFrame, DataFrame]:
    """Hash-guarded upsert of ``source`` (unique on ``keys``) into a table stored by ``part``: the table, and the keys of the new or changed rows.

    ``value`` gives a row's partition. Of the stored rows only keys, hashes and partitions are read to find the new and changed ones:
    where the key decides the partition (``by_key``) only in the source's partitions, else of all, but what misses a Bloom filter of the source's
    keys is not moved. Then only partitions a changed row leaves or enters are read in full and replaced. A load that changes nothing writes nothing.
    Many rows are replaced in several commits, one after the other (``_commits``), so that what is moved and held twice is one commit's; with
    ``by_key`` changes, too, are looked for commit by commit.
    Spark's committer holds the new content of a commit complete beside the table before it replaces the first directory. Replacing the directories is
    not atomic for readers; a catalog with row-level MERGE does better. ``stored`` says that the source is read from files
    at little cost, so that it need not be written to be read again. ``keep`` stores the changed keys.
    """
    spark = source.sparkSession
    path = f"{_path(root, table)}/{_PARTS}"
    rows, columns = conform(source, table), [f.name for f in schema(table)]
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        if not _versions(spark, _path(root, table)):
            _write_parts(rows, path, part, value)
            now = read_table(spark, root, table)
            return now, now.select(*keys)
        before = read_table(spark, root, table)  # published rows are where the merge starts
        with staged(spark) as stage:
            rows = stage(rows)
            changed = keep(changed_rows(before, rows, keys).select(*keys))
            _write_parts(upsert(before, rows, keys, source_unique=True), path, part, value)
        return read_table(spark, root, table), changed

    to, at = _part_names(value), _part_names(F.col(part))

    def differing(rows: DataFrame, there: DataFrame, held: list[str], store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, set[str], set[str], bool]:
        """The ``held`` columns of new and changed rows, the partitions these enter and leave, and whether a key has more than two copies."""
        there = there.select(*keys, "row_hash", at.alias("__part"))
        # A commit cut off half way may have left a key in two partitions; such a key counts as changed in both.
        known = there.groupBy(*keys).agg(F.min("row_hash").alias("__hash"), F.min("__part").alias("__first"),
                                         F.max("__part").alias("__last"), F.count("*").alias("__copies")).alias("t")
        hash_differs = F.col("__hash").isNull() | (F.col("__hash") != F.col("s.row_hash")) | (F.col("__copies") > 1)
        changed = store(
            rows.select(*{*held, *keys, "row_hash"}, to.alias("__to")).alias("s").join(known, same_key("s", "t", keys), "left")
            .where(F.col("__copies").isNull() | hash_differs)
            .select(*[f"s.{c}" for c in held], "__to", "__first", "__last", "__copies"))
        entered = changed.select(F.col("__to").alias("p"))
        left = changed.where(F.col("__copies").isNotNull()).select(F.explode(F.array("__first", "__last")).alias("p"))
        entered, left = [{r.p for r in some.distinct().collect()} for some in (entered, left)]
        many = changed.where(F.col("__copies") > 2).select(*[F.col(k).alias(f"__{k}") for k in keys])
        if strays := bool(many.take(1)):  # other partitions than the first and last may hold such a key
            left |= {r.p for r in there.join(many, _same_keys(keys), "left_semi").select(F.col("__part").alias("p")).distinct().collect()}
        return changed, entered, left, strays

    def has_null_key(changed: DataFrame) -> bool:
        return bool(changed.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).take(1))

    def paired(changed: DataFrame) -> DataFrame:
        return changed.select(*[F.col(k).alias(f"__{k}") for k in keys])

    def replace(fresh: DataFrame, gone: DataFrame, entered: set[str], left: set[str], null_keys: bool) -> None:
        """One commit: ``fresh`` rows take the place of the stored ones of the keys ``gone``, of which only keys are compared. NULL keys are one key here."""
        coming = fresh.dropDuplicates(keys) if null_keys else fresh

        def staying(parts: set[str]) -> DataFrame:
            before = _read_parts(spark, path, table, part, [None if p == _NULL_PART else p for p in sorted(parts)])
            return before.join(gone, _same_keys(keys, null_keys), "left_anti")

        emptied = left - entered
        if emptied:
            emptied -= {_NULL_PART if r.p is None else r.p for r in staying(emptied).select(F.col(part).alias("p")).distinct().collect()}
        _write_parts(staying(entered | left).select(columns).unionByName(coming), path, part, value, replace=True)
        # Emptied directories go last: a load cut off before leaves keys in two partitions, which the same load repeated finds.
        for name in emptied:
            fs.delete(_folder(spark, f"{path}/{part}={name}")[0], True)
        spark.catalog.refreshByPath(path)

    with staged(spark) as stage:
        rows = rows if stored else stage(rows)
        if by_key:
            found = []
            for some, there in in_turn(rows, root, table, part, value):
                with staged(spark) as brief:
                    changed, entered, left, _ = differing(some, there, columns, brief)
                    if entered | left:
                        found.append(keep(changed.select(*keys)))
                        replace(changed.select(columns), paired(changed), entered, left, has_null_key(changed))
            return read_table(spark, root, table), reduce(DataFrame.unionByName, found) if found else empty(spark, table).select(*keys)

        all_there = conform(spark.read.schema(schema(table)).parquet(path), table, part)
        changed, entered, left, strays = differing(rows, may_match(all_there.select(*keys, "row_hash", part), rows, keys), keys, keep)
        touched, null_keys = entered | left, has_null_key(changed)
        moved = changed.select("__to", F.explode(F.array("__first", "__last")).alias("__from")).where(F.col("__from") != F.col("__to"))
        moves = [tuple(r) for r in moved.distinct().limit(_MOVES + 1).collect()]
        commits = [touched] if touched else []
        if touched and not strays and not null_keys and len(moves) <= _MOVES:
            commits = _commits(_count_by(changed, F.col("__to")) + _count_by(all_there.where(at.isin(touched)), at), moves)
        for names in commits:
            whole = names == touched
            coming = rows.where(F.lit(True) if whole else to.isin(names))
            entering = changed if whole else changed.where(F.col("__to").isin(names))
            leaving = changed if whole else changed.where(F.col("__first").isin(names) | F.col("__last").isin(names))
            replace(coming.join(paired(entering), _same_keys(keys, null_keys), "left_semi"), paired(leaving), entered & names, left & names, null_keys)
    return read_table(spark, root, table), changed.select(*keys)
