"""A corpus through five stages: language, quality, near-duplicates, secrets,
packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared checkpoint folder and rereads it as the
next stage's documents.  All but the last return the columns of documents.

1. language ID: rows that are ``und``, or that no language model codes below
   8 bits a byte, go.
2. quality classifier: rows scored below 0.3 go.
3. near-duplicates: the smallest document of each class stays.
4. secret scan: found spans are masked in the text (no row goes).
5. packing: the pieces of what is left, each with its sequence and offset.

Defined cases are those of the operators: null and empty texts are ``und`` and
go in the first stage; repeated rows of one id stay once after the third; an
empty table gives an empty result; extra columns are carried to the fourth
stage and left out by the fifth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import langid, near_dup, packing, quality_model, secrets_scan
from plumbline.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Models, signatures and token ids have no SQL twin; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
