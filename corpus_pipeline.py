"""A cleaning pipeline over `documents`, made of the training-data operators.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet in the shared folder and
read again as the next stage's docs.  All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm.common import checkpoint_dir, read_table
from aerolith.llm.decontamination import remove_contaminated
from aerolith.llm.line_dedup import without_repeated_lines
from aerolith.llm.ngram_join import keep_one_of_each
from aerolith.llm.packing import pack_documents
from aerolith.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on these documents' labels, does not reject."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines, n_chars counted anew where a text changes; emptied documents go."""
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their sequences."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
#: SQL cannot express the classifier's fit or the packing; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
