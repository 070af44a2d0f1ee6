"""Silver as bucketed tables, so that vendors join without an exchange.

Both vendors' rows are dealt by the hash of (ticker, date) into the same number
of buckets when they are written, once; every reconciliation after that reads
bucket against bucket.  A hot ticker's days lie in different buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEYS = ("ticker", "date")


def write_bucketed(silver: DataFrame, table: str, path: str, buckets: int) -> None:
    """Replace ``table`` (its files lie under ``path``): one file a bucket, as
    rows are dealt to their buckets before the write."""
    (silver.repartition(buckets, *KEYS).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(table))


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
