"""A corpus pipeline: language ID, exact dedup, n-gram Jaccard join, benchmark decontamination, packing.

Nulls and empty texts go in the language stage, as they hold no letter. A null doc_id counts as the largest. Of repeated rows with one
doc_id and one text the dedup stages keep all or none. Very long texts are handled whole. An empty table passes every stage
and gives no pieces. Other columns are kept up to packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import core, decontamination, exact_dedup, jaccard_join, language_id, packing

#: SQL cannot express the learned classifier or the tokenizer; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go. Every other one gets some language, so the classifier decides nothing about what stays."""
    model = language_id.fit_on(docs.where(~language_id.held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))
    return language_id.keep_identified(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked by the n-gram Jaccard join the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or with a few word edits, go."""
    return decontamination.keep_clean(docs, core.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    return packing.with_digest(packing.pack(docs))


STAGES = [("language ID", languages), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminated), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and read again, and the one before is removed."""
    docs = core.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        last, docs = docs, core.written(stage(spark, docs, sf_dir))
        core.dropped(last)
    return STAGES[-1][1](spark, docs, sf_dir)
