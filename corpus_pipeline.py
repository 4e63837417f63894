"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
kept, and returns a DataFrame; ``run`` writes it as Parquet to the shared
folder and reads it again for the next. All stages but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from arrlens.llm.common import delete, scratch, table
from arrlens.llm.decontaminate import clean_documents
from arrlens.llm.jaccard_join import one_of_each
from arrlens.llm.line_dedup import without_frequent_lines
from arrlens.llm.packing import packed
from arrlens.llm.quality_rules import kept_documents
from arrlens.llm.tokens import vocabulary_file
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    out = without_frequent_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences."""
    return packed(docs, vocabulary_file("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: The isolation forest and the packing have no SQL; tests/llm compares each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # nothing reads the table of the stage before any more
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
