"""Training corpus pipeline: documents in, token shards out.

Five stages, each one operator on all that its predecessor kept; between
stages the documents are written as Parquet and read again.

1. language_id: documents without a recognisable language go;
2. near_dedup: one document of every near-duplicate group stays;
3. decontamination: documents contaminated by the benchmark go;
4. mixing: sources are brought to their targets; documents repeat as often as
   the mix takes them, or not at all, and are laid in training order;
5. token_shards: token ids in seekable shards, read back per document.
   Shards are in id order, so the copies of a document lie side by side.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelake.llm.common import run_folder, stored, table
from pricelake.llm.decontaminate import decontaminated
from pricelake.llm.langid import identified
from pricelake.llm.mixing import mixed
from pricelake.llm.near_dedup import near_deduplicated
from pricelake.llm.tokens import tokenized


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenized(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("token_shards", token_shards)]

#: Language identification, signatures and tokenising are not SQL; the tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, start, n_tokens, ids_crc32 of
    every written copy."""
    folder = run_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
