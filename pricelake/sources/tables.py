"""Reading the supplied parquet tables (declared columns only).

Reading parquet without a schema starts a job that reads file footers to
infer it.  The supplied tables are read-only, so each table's schema is
inferred once per process and declared on every later read: planning a query
starts no jobs, however often it reads the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df
