"""A training corpus from documents: quality, toxicity, near-duplicates, repeated passages, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of documents. run() writes each stage's result to the shared folder and reads it
again for the next, so a lost executor never costs an earlier stage.

1. quality: documents that the classifier rejects go. 2. toxicity: documents with toxic clauses go.
3. near-duplicates: one document of each class stays, the one with the smallest doc_id; of rows equal in doc_id and text one.
4. repeated passages: of a passage of 50 words or more the first occurrence stays; a document of which nothing is left goes.
5. packing: what is left, in packs along a Hilbert curve.

Nulls, empty texts, ties, repeated rows and empty tables: as the operators' modules say. Columns besides those
of documents are dropped. Rows without doc_id pass the first four stages where their text does, and are in no pack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colophon.llm import packing, quality, simhash, suffix_dedup, toxicity
from colophon.llm.common import DOCUMENT_COLUMNS, documents, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT_COLUMNS)
    return quality.accepted(docs, quality.fit(docs, _labels(spark, sf_dir)))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT_COLUMNS)
    return toxicity.without_toxic(docs, toxicity.learned_insults(docs, _labels(spark, sf_dir)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs.select(*DOCUMENT_COLUMNS))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs.select(*DOCUMENT_COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packs(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
