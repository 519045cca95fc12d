"""A stored table with one row per key, updated in place (SNK-7).

Rows lie in folders by a hash of their key. An update finds the folders its
keys fall into, reads only those, lets the row of largest sequence win per
key, and rewrites only those through dynamic partition overwrite; all other
files stay as they are. At 100 TB an update of few keys costs a few folders,
not the table.

The new contents of the touched folders are first written next to the table
(``_pending``, which readers skip) and then put in place. A job that dies
before that leaves the table as it was; one that dies while putting them in
place is finished by the next update or by ``recover``, with the same rows.
An update may run twice: the same rows win again. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.upsert import latest_by_key
from tessera.sinks import store

FOLDER = "bucket"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: Sequence[str], dynamic: bool = False) -> None:
    # the range key goes on with the table's key: a large folder is written by several tasks;
    # rows that are put in place come from files that were dealt out so before
    dealt = rows if dynamic else rows.repartitionByRange(FOLDER, *key)
    out = dealt.sortWithinPartitions(FOLDER, *key).write.mode("overwrite").partitionBy(FOLDER)
    (out.option("partitionOverwriteMode", "dynamic") if dynamic else out).parquet(path)


def create(df: DataFrame, path: str, key: Sequence[str], seq: str, buckets: int) -> None:
    """Store ``df`` (the last row per key by ``seq``) in ``buckets`` folders."""
    _write(latest_by_key(df, key, seq).withColumn(FOLDER, bucket_of(key, buckets)), path, key)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(FOLDER)


def recover(spark: SparkSession, path: str, key: Sequence[str]) -> bool:
    """Put a finished ``_pending`` in place, if an earlier update left one."""
    pending = f"{path}/_pending/rows"
    done = store.is_complete(spark, pending)
    if done:
        _write(spark.read.parquet(pending), path, key, dynamic=True)
    store.delete(spark, f"{path}/_pending")
    return done


def upsert(updates: DataFrame, path: str, key: Sequence[str], seq: str, buckets: int) -> list[int]:
    """Apply ``updates`` (columns of the table, in any order) and return the
    folders rewritten. Per key the row with the largest ``seq`` wins, the
    stored one on a tie; no updates touch nothing. ``buckets`` is the number
    the table was created with; at most so many numbers reach the driver."""
    spark = updates.sparkSession
    recover(spark, path, key)
    dealt = updates.withColumn(FOLDER, bucket_of(key, buckets))
    touched = sorted(r[0] for r in dealt.select(FOLDER).distinct().collect())
    if not touched:
        return []
    stored = spark.read.parquet(path)
    old = stored.filter(F.col(FOLDER).isin(touched))
    both = (old.withColumn("of_table", F.lit(1)).unionByName(dealt.select(*stored.columns, F.lit(0).alias("of_table")))
            .withColumn("turn", F.struct(seq, "of_table")))
    latest = latest_by_key(both, [*key, FOLDER], "turn").select(*stored.columns)
    _write(latest, f"{path}/_pending/rows", key)
    recover(spark, path, key)
    return touched
