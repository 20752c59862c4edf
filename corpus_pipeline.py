"""A corpus from raw documents: quality, boilerplate lines, near copies, benchmark leaks, mix of sources.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns
of documents; the last adds how often the mix takes each document. Stages handle nulls, empty texts, repeated rows and
empty tables as their operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import decontaminate, line_dedup, mixing, ngram_join, weak_quality
from concord.llm.common import Tables, table

#: Near copies: shingles of five words, Jaccard similarity of 0.8 or more.
WIDTH, PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer rejects go."""
    return weak_quality.filter_good(docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its texts; n_chars counts what is left, where the column is there."""
    names = docs.columns
    out = line_dedup.drop_boilerplate(docs)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, however many rows have that id or none."""
    return ngram_join.keep_one(docs, WIDTH, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item within its edit budget go."""
    return decontaminate.filter_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with mixed_size (words), mixed_target (words of the source) and copies (how often)."""
    return mixing.mix_rows(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_boilerplate_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix_sources),
]

#: The first stage learns its weights and the third verifies sets of hashes; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again, and goes once the next one is
    there."""
    tables = Tables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = tables.put(docs)
            if i:
                tables.drop(before)
    return docs
