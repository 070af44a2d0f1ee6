"""Gold table store on plain parquet with idempotent upserts.

A table is a set of parts: months of a fact's date key, years of the
calendar, one part for other tables.  Data lies in
``{table}/version=N/part=P``; a manifest ``{table}/_manifest/N.json`` names
the version that holds each part.  An upsert reads only the parts its batch
touches, writes them once into a new version, and then publishes the next
manifest in one rename; what no kept manifest names any more is deleted last.
A crash at any step leaves the former manifest and all its data in place.
``keep`` former manifests stay with their data, so that a query planned on one
of them still finds its files.  One writer per table at a time.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import upsert
from ..schemas import GOLD_TABLES
from ..session import lake_root
from . import fs

#: Rule that deals a table's rows to parts (bounded: months, years, one).
PARTS = {
    "fact_price_daily": "month",
    "fact_price_daily_consensus": "month",
    "fact_corporate_action": "month",
    "fact_macro_rate": "month",
    "dim_date": "year",
}


def part_of(table: str) -> Column:
    rule = PARTS.get(table)
    if rule == "month":
        return F.floor(F.col("date_key") / 100).cast("int")
    return F.col("year").cast("int") if rule == "year" else F.lit(0)


#: Former states of a table that the pipeline's verbs leave to running readers.
KEPT = 3


class GoldStore:
    def __init__(self, spark: SparkSession, root: str | None = None, keep: int = 0):
        self.spark, self.keep = spark, keep
        self.root = (root or f"{lake_root(spark)}/gold").rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _numbers(self, table: str) -> list[int]:
        names = fs.children(self.spark, f"{self.path(table)}/_manifest")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _manifest(self, table: str, number: int | None = None) -> tuple[int, dict[int, int]]:
        """(number, part -> version) of the published state, or of a former one."""
        found = self._numbers(table)
        if not found:
            return 0, {}
        n = found[-1] if number is None else number
        text = fs.read_text(self.spark, f"{self.path(table)}/_manifest/{n:09d}.json")
        return n, {int(k): v for k, v in json.loads(text).items()}

    def exists(self, table: str) -> bool:
        return self._manifest(table)[0] > 0

    def read(self, table: str, parts: list[int] | None = None) -> DataFrame:
        """The table, or the given parts of it (only their files are listed)."""
        schema, _ = GOLD_TABLES[table]
        held = self._manifest(table)[1]
        folders = [f"{self.path(table)}/version={v}/part={p}" for p, v in sorted(held.items())
                   if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def upsert(self, table: str, incoming: DataFrame, update_cols: list[str] | None = None) -> None:
        schema, keys = GOLD_TABLES[table]
        number, held = self._manifest(table)
        # the batch feeds the list of touched parts, the duplicate-key guard
        # and the merge: hold it meanwhile (lost blocks are recomputed)
        incoming = incoming.select(*schema.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r.part for r in incoming.select(part_of(table).alias("part")).distinct().collect())
            if not touched and number:
                return
            merged = upsert(self.read(table, touched), incoming, keys, update_cols)
            version = f"{self.path(table)}/version={number + 1}"
            fs.delete(self.spark, version)  # of a run that broke off
            self._write(merged.withColumn("part", part_of(table)), version)
        finally:
            incoming.unpersist()
        written = [int(n.partition("=")[2]) for n in fs.children(self.spark, version) if n.startswith("part=")]
        self._publish(table, number + 1, {**held, **dict.fromkeys(written, number + 1)})
        self.clean(table)

    def _write(self, merged: DataFrame, version: str) -> None:
        # dealt by part, so that a part is written by few tasks; a hot part is
        # split again and small ones are put together by their measured sizes
        merged.hint("rebalance", "part").write.partitionBy("part").parquet(version)

    def _publish(self, table: str, number: int, held: dict[int, int]) -> None:
        fs.write_text(self.spark, f"{self.path(table)}/_manifest/{number:09d}.json", json.dumps(held))

    def clean(self, table: str) -> None:
        """Delete the parts and manifests that no kept manifest names."""
        numbers = self._numbers(table)
        kept_numbers = numbers[-1 - self.keep:]
        named = {(p, v) for n in kept_numbers for p, v in self._manifest(table, n)[1].items()}
        for name in fs.children(self.spark, self.path(table)):
            if not name.startswith("version="):
                continue
            folder, v = f"{self.path(table)}/{name}", int(name.partition("=")[2])
            kept = {f"part={p}" for p, at in named if at == v}
            if not kept:
                fs.delete(self.spark, folder)
                continue
            for part in fs.children(self.spark, folder):
                if part.startswith("part=") and part not in kept:
                    fs.delete(self.spark, f"{folder}/{part}")
        for name in fs.children(self.spark, f"{self.path(table)}/_manifest"):
            if name not in {f"{n:09d}.json" for n in kept_numbers}:
                fs.delete(self.spark, f"{self.path(table)}/_manifest/{name}")
