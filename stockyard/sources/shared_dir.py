"""The folder for cut lineage and scratch tables."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCK = threading.Lock()
_CHOSEN: dict[str, str] = {}  # by application


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, the same at every call. A local session without one gets a folder of its own."""
    context = spark.sparkContext
    with _LOCK:
        named = _CHOSEN.get(context.applicationId)
        if named is None:
            named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING) or context.getCheckpointDir()
            if not named:
                if not context.master.startswith("local"):
                    raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
                named = tempfile.mkdtemp(prefix="stockyard-")
            _CHOSEN[context.applicationId] = named
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder: same rows in the same partitions after any retry."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def at_rest(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written as compressed columns to the shared folder and read back: same rows, in other partitions, and later steps read only the columns they need."""
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(spark: SparkSession):
    """Gives an ``at_rest`` whose files go when the block ends; nothing read from them may leave it."""
    root = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    try:
        yield lambda df: at_rest(df, root)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession):
    """Within the block a query's shuffle files go when it ends, not when the driver's garbage collector finds them unused: a load of many
    steps then holds the files of those that run."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
