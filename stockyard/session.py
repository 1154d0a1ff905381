"""Session settings the operators are written for."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Longer methods are not compiled by the JVM: steps that parse many columns then run as one interpreted method unless Spark cuts them up.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}
SETTINGS = {
    **METHOD_LIMIT,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", name: str = "stockyard", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own; see README."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name).config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def together(spark: SparkSession, *steps: Callable) -> list:
    """Results of independent steps, their Spark jobs sharing the cluster at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]
