import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockyard.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "stockyard-tests", "4g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows from a schema text and tuples; text is cast to the stated type."""
    def make(schema, *data):
        from pyspark.sql import types as T
        kinds = T.StructType.fromDDL(schema)
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in kinds])
        df = spark.createDataFrame([tuple(None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r) for r in data], as_text)
        return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in kinds])
    return make


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
