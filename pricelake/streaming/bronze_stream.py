"""File-source stream over a vendor's bronze landings.

The reference re-pulls full history on a daily batch and absorbs late or
revised data through idempotent upserts.  The same contract makes a
streaming form safe: new landing files are picked up by a file-source
stream (``availableNow`` processes everything new and stops), and each
micro-batch runs gate → silver → upsert.  Because the upsert is keyed and
idempotent, a micro-batch replayed after a failure changes nothing; a later
re-delivery of a key replaces the earlier one (keep-last across batches).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import facts, quality
from ..operators.silver import to_silver
from ..schemas import NATIVE_ADJUSTED, PRIMARY_BRONZE
from ..session import lake_root
from ..sources import fs
from ..sources.bronze import ARRIVAL, _with_parts, batch_path, checked_columns, dataset_path
from ..sources.gold import KEPT, GoldStore


def price_stream(spark: SparkSession, root: str, dataset: str, schema: T.StructType = PRIMARY_BRONZE,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of every row landed under a bronze dataset."""
    r = spark.readStream.schema(_with_parts(schema))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(dataset_path(root, "bronze", dataset))
    return (df.withColumn("_arrival_batch", F.col("batch")).withColumn("_arrival_file", F.col("_metadata.file_path"))
            .withColumn("_arrival_row", F.col("_metadata.row_index")))


def with_own_columns(batch: DataFrame, root: str, dataset: str, schema: T.StructType) -> DataFrame:
    """The micro-batch, with what the declared schema hides: a landing that
    lacks a required column fails the stream, and where a vendor may send
    adjusted prices ``_native`` says which rows came with them.  A micro-batch
    holds at most as many landings as files."""
    spark = batch.sparkSession
    found = [(r.ingest_date, r.batch) for r in batch.select("ingest_date", "batch").distinct().collect()]
    native = [(d, b, NATIVE_ADJUSTED <= checked_columns(spark, batch_path(root, "bronze", dataset, d, b), schema)) for d, b in found]
    if not NATIVE_ADJUSTED <= set(schema.fieldNames()):
        return batch
    told = spark.createDataFrame(native, "ingest_date date, batch int, _native boolean")
    return batch.join(F.broadcast(told), ["ingest_date", "batch"])


#: Files a micro-batch reads at most: the backlog is worked off in steps.
MAX_FILES = 1000
QUARANTINE = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]


def stream_folder(root: str, what: str, source: str) -> str:
    """Where a stream's gate reports, rejects and load counts go."""
    return f"{root.rstrip('/')}/gold/_stream_{what}/{source}"


def run_price_stream(spark: SparkSession, source: str, dim_date: DataFrame, dim_security: DataFrame,
                     root: str | None = None, dataset: str | None = None,
                     schema: T.StructType = PRIMARY_BRONZE, checkpoint: str | None = None,
                     wait: bool = True, max_files: int | None = MAX_FILES):
    """Process every new landing of ``source`` once (availableNow trigger).

    Per micro-batch: the gate report is written; rows that break a rule about
    single rows go to quarantine with the rule's name; the others are built
    into facts and upserted; rows without a security or date key are
    quarantined too; and the load counts are written.  Each of the three
    sinks has a folder per epoch, so a replayed batch replaces its own.
    ``max_files`` bounds what one micro-batch reads.
    Returns the StreamingQuery (finished when ``wait``)."""
    root = root or lake_root(spark)
    dataset = dataset or f"{source}_prices"
    store = GoldStore(spark, f"{root}/gold", keep=KEPT)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch = with_own_columns(batch, root, dataset, schema).drop("ingest_date", "batch")

        def put(df, what):
            fs.replace(df, root, f"{stream_folder(root, what, source)}/epoch_id={epoch_id}")

        put(quality.evaluate(batch.drop(*ARRIVAL, "_native"), quality.price_rules(), source), "gate_reports")
        reason = quality.row_violation(quality.price_rules())
        good = batch.where(reason.isNull())
        silver = to_silver(good, source)
        rows, counts = facts.fact_price_daily(silver, source, dim_date, dim_security)
        store.upsert("fact_price_daily", rows)
        lost = facts.unresolved(silver, dim_date, dim_security)
        put(batch.where(reason.isNotNull()).select(*QUARANTINE, reason.alias("reason"))
            .unionByName(lost.select(*QUARANTINE, "reason")), "rejects")
        put(counts, "loads")

    q = (price_stream(spark, root, dataset, schema, max_files).writeStream
         .foreachBatch(handle)
         .option("checkpointLocation", checkpoint or f"{root}/_streams/{dataset}")
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q
