"""Documents to packed training sequences, in five stages.

Every stage reads whole texts of all its predecessor kept. Stages but the last return the columns they get, in their order, whatever
further columns there are; none counts on doc_id or text being there in a row, and an empty table passes through all of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starlens.llm import decontam, neardup, packing, quality, substring
from starlens.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule of policy v1 rejects. Null and empty texts have no words and go; repeated rows fare alike."""
    return quality.filter_documents(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id. Rows with equal doc_id are one document and fare alike; a null doc_id stays."""
    return neardup.keep_one(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of passages that one with a smaller doc_id has too. Null doc_ids neither lose nor take words."""
    return substring.rewrite(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no benchmark window occurs in. Null texts hold none; items without id or text are allowed."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens; a null or empty text is its end token. Repeated rows are each packed."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: SQL has no tokenizer; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again, and then its input's are deleted."""
    here = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{here}/{k}")
        docs = spark.read.parquet(f"{here}/{k}")
        if k:
            delete(spark, f"{here}/{k - 1}")
    return docs


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
