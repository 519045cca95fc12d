"""Reports: a result written in a whole order (SRT-5, SRT-10), read back with
line numbers over all its files.

The writer sorts by ranges, so that part files taken by name hold the report
from its first line to its last, whatever its size; no task holds it all. The
reader numbers the lines of a folder the way ``cat`` of its files would: it
counts the lines of each split (a file, or a block of a large file), adds the
counts up in (file, block) order and joins them back. The driver handles one
count per split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import offsets

PART_NUMBER = r"part-(\d+)"


def write_report(df: DataFrame, path: str, order: Sequence, mode: str = "errorifexists") -> None:
    """``df`` as CSV part files, in ``order`` from one file to the next."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).csv(path)


def _split_lines(rows: DataFrame) -> tuple[DataFrame, list]:
    """``rows`` of a file scan with each row's split (``report_file``,
    ``report_block``) and place (``report_at``), and the splits in the order
    of their part numbers, names and blocks, with rows and first place."""
    names = rows.columns
    rows = rows.select(*names, F.col("_metadata.file_name").alias("report_file"),
                       F.col("_metadata.file_block_start").alias("report_block"),
                       F.monotonically_increasing_id().alias("report_at"))
    number = F.regexp_extract("report_file", PART_NUMBER, 1)
    splits = (rows.groupBy("report_file", "report_block").agg(F.count(F.lit(1)).alias("n"), F.min("report_at").alias("first"))
              .withColumn("number", F.when(number != "", number).cast("long")).collect())
    return rows, sorted(splits, key=lambda r: (r.number is None, r.number or 0, r.report_file, r.report_block))


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a CSV folder with ``position``, the line's number (from 1)
    over all files, taken by part number. Lines may not hold line breaks in
    quoted values. An empty folder gives no rows."""
    rows, splits = _split_lines(spark.read.schema(schema).csv(path))
    starts = spark.createDataFrame([(r.report_file, r.report_block, before - r.first + 1)
                                    for r, before in zip(splits, offsets([r.n for r in splits]))],
                                   "report_file string, report_block long, shift long")
    names = [c for c in rows.columns if not c.startswith("report_")]
    return rows.join(starts, ["report_file", "report_block"]).select(*names, (F.col("report_at") + F.col("shift")).alias("position"))


def read_part_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a folder of part files: ``value``, the ``part`` number,
    the ``line`` of that part (from 1) and how many ``lines`` the part has."""
    rows, splits = _split_lines(spark.read.text(path))
    of_part: dict[int, list] = {}
    for r in splits:
        of_part.setdefault(r.number, []).append(r)
    starts = [(r.report_file, r.report_block, part, before - r.first + 1, sum(x.n for x in own))
              for part, own in of_part.items() for r, before in zip(own, offsets([x.n for x in own]))]
    starts = spark.createDataFrame(starts, "report_file string, report_block long, part int, shift long, lines long")
    return (rows.join(starts, ["report_file", "report_block"])
            .select("value", "part", (F.col("report_at") + F.col("shift")).alias("line"), "lines"))
