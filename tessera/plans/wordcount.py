"""Word-count jobs over ``documents.text`` (Q-WC, Q-WC-ALPHA and the
questions asked about their output files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import DEFAULT_REDUCERS
from tessera.operators.wordcount import bucket_edges, vocabulary_size, with_bucket, word_count
from tessera.sinks.files import read_term_counts, write_part_files, write_term_counts
from tessera.sinks.reports import read_part_lines
from tessera.session import scratch_dir
from tessera.sources.tables import table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("text")


def wordcount(spark: SparkSession, sf_dir: str, alpha_only: bool = False) -> DataFrame:
    return word_count(_docs(spark, sf_dir), "text", alpha_only)


def unique_terms(spark: SparkSession, sf_dir: str, alpha_only: bool = False) -> DataFrame:
    return vocabulary_size(wordcount(spark, sf_dir, alpha_only))


def term_buckets(spark: SparkSession, sf_dir: str, n: int = DEFAULT_REDUCERS) -> DataFrame:
    return with_bucket(wordcount(spark, sf_dir), n)


def bucket_first_and_third_last(spark: SparkSession, sf_dir: str, alpha_only: bool = False,
                                n: int = DEFAULT_REDUCERS) -> DataFrame:
    return bucket_edges(with_bucket(wordcount(spark, sf_dir, alpha_only), n))


def wordcount_tsv_roundtrip(spark: SparkSession, sf_dir: str, alpha_only: bool = False,
                            n: int = DEFAULT_REDUCERS) -> DataFrame:
    """SNK-1 + SNK-2: write the counts as ``n`` tab-separated part files
    (one per hash bucket, byte-sorted inside), replacing any old output,
    then read them back."""
    path = scratch_dir(spark, "wordcount")
    write_term_counts(wordcount(spark, sf_dir, alpha_only), path, n)
    return read_term_counts(spark, path)


def part_edges_from_files(spark: SparkSession, sf_dir: str, alpha_only: bool = False,
                          n: int = DEFAULT_REDUCERS) -> DataFrame:
    """SRT-8 as the question is put: the counts are written as ``n`` part
    files, and the first and the third line from the end of each are read."""
    path = scratch_dir(spark, "parts")
    write_part_files(wordcount(spark, sf_dir, alpha_only), path, n)
    lines = read_part_lines(spark, path)
    term, count = F.substring_index("value", "\t", 1), F.substring_index("value", "\t", -1).cast("long")
    edge = (F.when(F.col("line") == 1, F.array(F.struct(F.lit("first").alias("position"), F.lit(1).alias("pos"))))
            .otherwise(F.array()))
    last = (F.when(F.col("line") == F.col("lines") - 2, F.array(F.struct(F.lit("from_last").alias("position"), F.lit(3).alias("pos"))))
            .otherwise(F.array()))
    return lines.select(F.col("part").alias("bucket"), F.inline(F.concat(edge, last)), term.alias("term"), count.alias("count"))
