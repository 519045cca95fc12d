"""Line text source (SRC-1) and a text corpus derived from ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: one row (``value``) per line of every text file under ``path``
    (splittable; each split is read by its own task)."""
    return spark.read.text(path)


def write_corpus(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the ``documents`` texts as plain text files (one or more lines
    per document), the input shape of the word-count jobs."""
    (table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
     .write.mode("overwrite").text(path))
