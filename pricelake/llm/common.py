"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: A word of the space-delimited contracts, as a Java and DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that go to a Python worker at a time: whole texts are long.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that name a row by its id and text; nulls differ from all values."""
    def part(c):
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))

    return F.unhex(F.md5(F.concat(part(id_col), F.lit("\n"), part(text_col))))


def set_aside(df: DataFrame):
    """``df`` with all columns under names of our own, so that none can clash
    with an operator's; the new name by the old; and the way back."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the storage that all executors share."""
    bounded_batches(spark)
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends at the files,
    which outlive any executor."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder through Spark's own file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
