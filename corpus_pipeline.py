"""The training-data pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet into the session's shared folder and hands the next stage
what it reads back.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saferow.llm import binary, decontam, mixing, simhash, toxicity
from saferow.llm.common import scratch, stored, table
from saferow.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents the network scores as toxic go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark passage go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document as many times as the mix takes it."""
    return mixing.mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token ids in seekable frames; what the files hold, by document."""
    return binary.read_token_files(binary.write_token_files(docs, scratch(spark, "corpus-frames"), vocabulary()))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("source_mixing", mix_sources),
          ("token_id_output", write_token_ids)]

#: No SQL: a trained network, XXH64 fingerprints and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
