"""Shared pieces of the training-data operators: word splitting, shared storage, sizes of Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.sources.store import Store as Tables  # noqa: F401

#: ASCII white space as the contracts define it; words are what stands between.
SPACE = r"[\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, none for an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluates value once and gives it to body, which may use it many times."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """The name, or with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Whole texts go to Python in batches of few rows, so that very long ones fit in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
