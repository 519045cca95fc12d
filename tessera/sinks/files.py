"""File sinks: delimited term/count part files (SNK-1, SNK-2, SNK-6) and CSV
result directories (SNK-3, SNK-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import DEFAULT_REDUCERS
from tessera.operators.wordcount import with_bucket
from tessera.sinks import store


def write_term_counts(counts: DataFrame, path: str, n: int = DEFAULT_REDUCERS,
                      key: str = "term", value: str = "count") -> None:
    """``key<TAB>value`` lines, one directory per hash bucket
    (``bucket=<i>``), byte-sorted by key inside. Replaces old output (SNK-2).

    One range shuffle on (bucket, key) into n tasks of like size: a bucket
    may be written by two neighbouring tasks (as two sorted files whose key
    ranges don't overlap), and no task idles. The sort satisfies the writer's
    required (bucket) ordering, so no second sort is added.
    """
    lines = (with_bucket(counts, n, key)
             .select("bucket", key, F.concat_ws("\t", F.col(key), F.col(value).cast("string")).alias("value"))
             .repartitionByRange(n, "bucket", key)
             .sortWithinPartitions("bucket", key)
             .select("bucket", "value"))
    lines.write.mode("overwrite").partitionBy("bucket").text(path)


def write_part_files(counts: DataFrame, path: str, n: int = DEFAULT_REDUCERS,
                     key: str = "term", value: str = "count") -> None:
    """SNK-1 with SNK-6: ``key<TAB>value`` lines in exactly ``n`` files,
    ``part-00000`` onwards; part i holds the keys of hash bucket i, byte-sorted,
    as a job with n reducers writes them. Replaces old output (SNK-2).

    The bucket is the partition id of the shuffle itself, so a part is one
    task's output, however large the others are; a bucket without keys gets
    an empty file. For parts that need not be single files,
    :func:`write_term_counts` splits a bucket over tasks.
    """
    lines = (with_bucket(counts, n, key).repartitionById(n, F.col("bucket")).sortWithinPartitions(key)
             .select(F.concat_ws("\t", F.col(key), F.col(value).cast("string")).alias("value")))
    lines.write.mode("overwrite").text(path)
    written = store.children(counts.sparkSession, path)
    for part in (f"part-{i:05d}" for i in range(n)):
        if not any(name.startswith(part) for name in written):
            store.touch(counts.sparkSession, f"{path}/{part}")


def read_term_counts(spark: SparkSession, path: str, key: str = "term", value: str = "count") -> DataFrame:
    """Read part files written by :func:`write_term_counts` (or any
    ``key<TAB>value`` text files) back as ``(key STRING, value BIGINT)``."""
    raw = spark.read.text(path)
    parts = F.split(F.col("value"), "\t", 2)
    return raw.select(parts.getItem(0).alias(key), parts.getItem(1).cast("long").alias(value))


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists",
              header: bool = False, order=()) -> None:
    """SNK-3 (directory of part files, fails if it exists by default) and
    SNK-4 (``single_file``: one part file, the caller's choice for results
    that one task can write, in report ``order``, SRT-10: sorted inside the
    single partition, no global sort)."""
    out = df
    if single_file:
        out = df.coalesce(1)
        if order:
            out = out.sortWithinPartitions(*order)
    out.write.mode(mode).option("header", header).csv(path)


def read_csv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    """Read a CSV directory with an explicit schema (never inferred)."""
    return spark.read.schema(schema).option("header", header).csv(path)
