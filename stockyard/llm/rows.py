"""Row numbers and texts, shared by the operators."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of a row's number inside the operators.
ROW = "__row"

#: ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: A row's place in its file takes the lower bits of its number.
_PLACE_BITS = 40


def numbered(df: DataFrame, name: str = ROW) -> DataFrame:
    """``df`` with a number per row, which replaces a column of that name.

    A number is made of the place of the row's file among all files, by path, and of the row's place in its file. Neither depends on how
    files are split into tasks, so every reading of the same files gives the same numbers, whatever executors or cores there are.
    ``df`` must be a plain reading of files, perhaps with row-wise expressions, not the outcome of a shuffle. Rows
    that come from no file (a list in a test) are numbered by partition and place there.

    The paths reach the driver, which has listed them anyway; a hash and a number for each, 16 bytes, go to the executors.
    """
    try:
        hidden = df.metadataColumn("_metadata")
        paths = [r[0] for r in df.select(hidden["file_path"]).distinct().collect()]
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    spark, file = df.sparkSession, unused(df.columns, "__file")
    at, key = f"{file}_at", f"{file}_key"
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(sorted(paths))], "path string, number long")
    # The seed is the first under which no two paths have one hash.
    for seed in range(64):
        files = listed.select(F.xxhash64(F.lit(seed), "path").alias(key), "number")
        if files.agg(F.count_distinct(key)).first()[0] == len(paths):
            break
    placed = df.select("*", F.xxhash64(F.lit(seed), hidden["file_path"]).alias(file), hidden["row_index"].alias(at))
    joined = placed.join(F.broadcast(files.withColumnRenamed("number", f"{file}_number")), F.col(file) == F.col(key))
    number = F.shiftleft(f"{file}_number", _PLACE_BITS).bitwiseOR(F.col(at))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()], number.alias(name))


def shard_of(df: DataFrame, shards: int, otherwise: Column) -> Column:
    """One of ``shards`` classes of files, or a class of ``otherwise`` for rows that come from no file. No split of the files changes it."""
    try:
        path = df.metadataColumn("_metadata")["file_path"]
        df.select(path)
    except AnalysisException:
        path = otherwise
    return F.pmod(F.xxhash64(path), F.lit(shards)).cast("int")


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until it begins none of ``columns``."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers ``dropped`` lists as ``__row``; all columns as they were, whatever their names."""
    row = unused(docs.columns, ROW)
    gone = dropped.select(F.col(ROW).alias(f"{row}_gone"))
    return numbered(docs, row).join(gone, F.col(row) == F.col(f"{row}_gone"), "left_anti").drop(row)


def whole(text: Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(text.cast("string"), F.lit(""))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
