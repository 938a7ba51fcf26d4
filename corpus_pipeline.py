"""A training corpus from raw documents in five stages: each keeps what it lets pass, as a table of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stridecast.llm import decontamination, langid, near_simhash, packing, pii
from stridecast.scratch import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: rejected ones (no letter, or a calibrated score under the limit) go."""
    model = langid.train(docs)
    return langid.identify(docs.select(*COLUMNS), model).where("NOT lang_rejected").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, once.

    Rows that repeat an id and text are one document; others are told apart by their text. If no row
    of a group has an id, the one whose text has the smallest hash is kept.
    """
    return near_simhash.first_rows(docs.select(*COLUMNS), shingle=4, most=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_benchmark(docs.select(*COLUMNS), benchmark).select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    return packing.with_crc(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", private),
    ("packing", packed),
]

#: Models, fingerprints and token ids have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
