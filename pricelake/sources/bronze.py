"""Bronze/silver partitioned storage: dated landings, partition scans with
arrival order, latest-partition lookup, dead-letter and silver sinks.

Layout: ``{root}/{layer}/{dataset}/ingest_date=YYYY-MM-DD/batch=N/part-*``.
Several landings for one date are separate ``batch`` partitions, so arrival
order is (batch number, file, row index) — what keep-last needs.  A batch
folder is written by one landing and has one schema; the columns a folder
physically holds are compared with the required ones before any schema is
declared, so drift fails instead of reading as NULL.
Folders whose name starts with ``_`` (dead letters) are ignored by scans.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NATIVE_ADJUSTED
from . import fs

ARRIVAL = ("_arrival_batch", "_arrival_file", "_arrival_row")
#: File beside a landing's data with the names of its columns.
COLUMNS = "_columns.json"
#: Columns a landing may lack; the scan says which rows came with them.
OPTIONAL = NATIVE_ADJUSTED | {"dividends", "stock_splits"}


def dataset_path(root: str, layer: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def batch_path(root: str, layer: str, dataset: str, ingest_date: dt.date, batch: int) -> str:
    return f"{dataset_path(root, layer, dataset)}/ingest_date={ingest_date.isoformat()}/batch={batch}"


def land(df: DataFrame, root: str, dataset: str, ingest_date: dt.date, batch: int = 0,
         layer: str = "bronze") -> None:
    """Write one landing for a date.  Re-landing the same (date, batch)
    replaces just that folder, also by an empty result; other landings are
    untouched.  The landing's columns are written beside it."""
    df = df.drop("ingest_date", "batch")
    fs.replace(df, root, batch_path(root, layer, dataset, ingest_date, batch), beside={COLUMNS: json.dumps(df.columns)})


def columns_of(spark: SparkSession, folder: str) -> set[str]:
    """The columns that a landing physically holds: as written beside it, or
    from a footer where another writer left none."""
    if fs.exists(spark, f"{folder}/{COLUMNS}"):
        return set(json.loads(fs.read_text(spark, f"{folder}/{COLUMNS}")))
    return set(spark.read.parquet(folder).columns)


def checked_columns(spark: SparkSession, folder: str, schema: T.StructType, required: set[str] | None = None) -> set[str]:
    """``columns_of``, or an error if a required one (default: all of the
    schema but the optional ones) is not there."""
    must = set(schema.fieldNames()) - OPTIONAL if required is None else set(required)
    have = columns_of(spark, folder)
    if must - have:
        raise ValueError(f"{folder}: columns {sorted(must - have)} are not there")
    return have


def dates(spark: SparkSession, root: str, dataset: str, layer: str = "bronze") -> list[dt.date]:
    """Ingest dates of a dataset, from folder names."""
    return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in fs.children(spark, dataset_path(root, layer, dataset))
                  if n.startswith("ingest_date="))


def batches(spark: SparkSession, root: str, dataset: str, ingest_date: dt.date, layer: str = "bronze") -> list[int]:
    """Landings of a date in order of arrival, from folder names."""
    day = f"{dataset_path(root, layer, dataset)}/ingest_date={ingest_date.isoformat()}"
    return sorted(int(n.partition("=")[2]) for n in fs.children(spark, day) if n.startswith("batch="))


def _with_parts(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("ingest_date", T.DateType()),
                                               T.StructField("batch", T.IntegerType())])


def scan(spark: SparkSession, root: str, dataset: str, schema: T.StructType,
         ingest_date: dt.date | None = None, layer: str = "bronze",
         arrival: bool = True, required: set[str] | None = None) -> DataFrame:
    """All rows of one ingest date (of all, without one) in a declared
    schema; a missing dataset or date is an empty frame, not an error.

    Each landing's own columns are checked first: one that lacks a
    ``required`` column (default: all but the optional ones) fails the scan.
    Landings are read by the optional columns they have, and those without
    native adjusted prices carry ``_native`` = false.  With ``arrival`` the
    batch, file and row index come along for keep-last."""
    path = dataset_path(root, layer, dataset)
    names = schema.fieldNames()
    flag = NATIVE_ADJUSTED <= set(names) and layer == "bronze"
    groups: dict[frozenset, list[str]] = {}
    for d in ([ingest_date] if ingest_date else dates(spark, root, dataset, layer)):
        for b in batches(spark, root, dataset, d, layer):
            folder = batch_path(root, layer, dataset, d, b)
            have = checked_columns(spark, folder, schema, required)
            groups.setdefault(frozenset(have & set(names)), []).append(folder)

    def finish(df, native):
        if flag:
            df = df.withColumn("_native", F.lit(native))
        if arrival:
            df = (df.withColumn("_arrival_batch", F.col("batch")).withColumn("_arrival_file", F.col("_metadata.file_path"))
                  .withColumn("_arrival_row", F.col("_metadata.row_index")))
        return df

    out = None
    for have, folders in groups.items():
        part = T.StructType([f for f in schema.fields if f.name in have])
        df = finish(spark.read.schema(_with_parts(part)).option("basePath", path).parquet(*folders), NATIVE_ADJUSTED <= have)
        for f in schema.fields:
            if f.name not in have:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        df = df.select(*names, *[c for c in df.columns if c not in names])
        out = df if out is None else out.unionByName(df)
    if out is None:
        out = spark.createDataFrame([], _with_parts(schema))
        if flag:
            out = out.withColumn("_native", F.lit(True))
        if arrival:
            out = (out.withColumn("_arrival_batch", F.lit(None).cast("int")).withColumn("_arrival_file", F.lit(None).cast("string"))
                   .withColumn("_arrival_row", F.lit(None).cast("long")))
    return out


def latest_date(spark: SparkSession, root: str, dataset: str, before: dt.date | None = None,
                layer: str = "bronze") -> dt.date | None:
    """Newest ingest date (strictly before ``before`` when given — a run must
    not find its own output), from folder names: no file is opened."""
    found = [d for d in dates(spark, root, dataset, layer) if before is None or d < before]
    return found[-1] if found else None


def latest_partition(spark: SparkSession, root: str, dataset: str, before: dt.date | None = None,
                     layer: str = "bronze") -> DataFrame:
    """``latest_date`` as a one-row frame."""
    return spark.createDataFrame([(latest_date(spark, root, dataset, before, layer),)], "latest_ingest_date date")


def write_rejects(rejects: DataFrame, root: str, ingest_date: dt.date, source: str) -> None:
    """Dead letters of one source and date: keys requested but not delivered,
    next to (not inside) the datasets so scans never read them.  The latest
    list replaces the former, also when it is empty."""
    fs.replace(rejects.select("key", "reason"), root,
               f"{root.rstrip('/')}/bronze/_rejects/ingest_date={ingest_date.isoformat()}/source={source}")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(key, reason, ingest_date, source) of all dead letters."""
    path = f"{root.rstrip('/')}/bronze/_rejects"
    schema = "key string, reason string, ingest_date date, source string"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_silver(silver: DataFrame, root: str, dataset: str, ingest_date: dt.date,
                 files: int | None = None) -> None:
    """Silver sink ordered by (ticker, date): range-partitioned on ticker so
    each file covers a ticker range (row-group min/max skipping works for
    ticker filters and both vendors' files line up for the join)."""
    spark = silver.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = silver.repartitionByRange(n, "ticker").sortWithinPartitions("ticker", "date")
    land(out, root, dataset, ingest_date, batch=0, layer="silver")
