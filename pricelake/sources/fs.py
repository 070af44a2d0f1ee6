"""File-system steps through Spark's own storage layer (any Hadoop scheme)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = spark._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"could not move {src} to {dst}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: written aside, then renamed."""
    fs, p = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, p.toString(), path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(df: DataFrame, root: str, path: str, beside: dict[str, str] | None = None) -> None:
    """Put ``df`` in the place of folder ``path``, also when it has no rows:
    written aside under ``root`` first, so a failed job changes nothing.
    ``beside``: small text files that appear in the folder with it."""
    spark = df.sparkSession
    aside = f"{root.rstrip('/')}/_writing/{uuid.uuid4().hex}"
    df.write.parquet(aside)
    for name, text in (beside or {}).items():
        write_text(spark, f"{aside}/{name}", text)
    delete(spark, path)
    move(spark, aside, path)
