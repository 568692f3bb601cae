"""Corpus pipeline: five training-data operators applied one after another to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before
kept; its result is written as Parquet and reread.  All stages but the last return the
columns of their input, also where those have clashing or additional names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.llm import decontam, packing, secrets, simhash, toxicity
from labelforge.llm.common import arrow_batches, read, unused, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go (the score learns from the labelled rows of ``docs``)."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    name = unused("_toxicity", docs.columns)
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule names go."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    name = unused("_benchmark", docs.columns)
    return decontam.scan_benchmark(docs, items, out=name) \
        .where(~decontam.contaminated(name)).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; every document stays."""
    return secrets.redact(docs, secrets.dictionary(read(spark, sf_dir, "conversations", "text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, chunk_bytes=CHUNK_BYTES)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Rows that a Python worker takes at a time, and text that it tokenizes at once.
BATCH_ROWS, CHUNK_BYTES = 2000, 3 << 20

# SQL cannot state trained models, SimHash components and a packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read(spark, sf_dir, "documents")
    # executors keep serving one stage after another: small batches bound what each leaves behind
    with arrow_batches(spark, BATCH_ROWS):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
