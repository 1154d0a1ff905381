"""Tables between the steps of an operator, in the shared folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockyard.sources.shared_dir import shared_dir


class Scratch:
    """Parquet tables that cut lineage: they outlive executors, their size is known to the planner, and they go when no longer needed."""

    def __init__(self, spark: SparkSession):
        self._spark, self._folder, self._paths = spark, f"{shared_dir(spark)}/steps-{uuid.uuid4().hex}", {}

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, written and read back."""
        path = f"{self._folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        kept = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = path, kept
        return kept

    def drop(self, *kept: DataFrame) -> None:
        """Removes tables of ``keep`` that nothing reads again."""
        jvm, conf = self._spark._jvm, self._spark._jsc.hadoopConfiguration()
        for df in kept:
            place = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(df))[0])
            place.getFileSystem(conf).delete(place, True)
