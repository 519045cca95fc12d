"""Query tables that grow by batches (SNK-5, AGG-12, AGG-15).

A table of sums (rating totals and counts per product and day, reviews per
group and customer, signed corrections of such counts) is kept as mergeable
partials: every batch adds its own sums in a folder named by the batch id.
Writing a batch again, after a failure or because it was delivered twice,
replaces that folder, so it never counts double. ``compact`` folds the batches
so far into a base in answer order; its folder names the last batch it holds,
and a reader takes the newest complete base and the batches after it. A base
that a failed job left behind is not complete and is not read. Folded batches
stay until ``prune``; a batch id that a base holds is refused, as its sums
could not be taken out again.

    <path>/batches/batch=<id>/...     sums of one batch
    <path>/base/through=<id>/...      all sums up to that batch, in order

Cost: a batch writes its own keys, a reader deals base and recent batches out
by key and adds them up there, and ``compact`` also moves the whole table into
order. The rows are dealt out as they are: each part holds a key once, so adding
up before the shuffle would save nothing, and would hold the keys of a whole
file split, which is millions of rows as these files are packed, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sinks import store
from tessera.sinks.query_tables import write_query_table


def numbers(spark: SparkSession, folder: str, prefix: str, complete: bool) -> list[int]:
    """The numbers of a folder's folders; with ``complete`` only of those that
    Spark has committed."""
    names = [n for n in store.children(spark, folder) if n.startswith(prefix)]
    return sorted(int(n[len(prefix):]) for n in names if not complete or store.is_complete(spark, f"{folder}/{n}"))


def folded(spark: SparkSession, path: str) -> int | None:
    """The last batch that the newest complete base holds."""
    return max(numbers(spark, f"{path}/base", "through=", True), default=None)


def add_batch(partials: DataFrame, path: str, batch_id: int, replay: bool = False) -> None:
    """Write the sums of one batch; the same id again replaces them. With
    ``replay`` the caller vouches that an id always comes with the same sums
    (a stream's micro-batches): one that is folded already is written, and not
    read, instead of refused."""
    done = folded(partials.sparkSession, path)
    if done is not None and batch_id <= done and not replay:
        raise ValueError(f"batch {batch_id} is folded into the base through batch {done}")
    partials.write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")


def merged(spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str], upto: int | None = None) -> DataFrame:
    """The table: base and later batches added up by ``keys`` (through batch
    ``upto``, by default all). Columns ``keys`` then ``sums``; rows whose sums
    are all 0 are gone, as after a correction that took all away."""
    base = folded(spark, path)
    later = [b for b in numbers(spark, f"{path}/batches", "batch=", True)
             if (base is None or b > base) and (upto is None or b <= upto)]
    parts = [f"{path}/batches/batch={b}" for b in later] + ([f"{path}/base/through={base}"] if base is not None else [])
    if not parts:
        raise ValueError(f"no batch in {path}")
    rows = spark.read.parquet(*parts).repartition(*keys)
    total = rows.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    any_left = F.lit(False)
    for s in sums:
        any_left = any_left | (F.col(s) != 0)
    return total.filter(any_left).select(*keys, *sums)


def compact(spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str],
            cluster_by: Sequence[str], order: Sequence = ()) -> int:
    """Fold all batches into a new base, clustered in answer order; returns
    the last batch it holds. With no new batch the base stays as it is."""
    base = folded(spark, path)
    last = max(numbers(spark, f"{path}/batches", "batch=", True), default=-1)
    if base is not None and last <= base:
        return base
    write_query_table(merged(spark, path, keys, sums, upto=last), f"{path}/base/through={last}", cluster_by=cluster_by, order=order)
    return last


def prune(spark: SparkSession, path: str) -> None:
    """Delete batches and bases that the newest complete base replaces. Not
    while a reader of the older ones is at work."""
    base = folded(spark, path)
    for folder, prefix, last in (("batches", "batch=", base), ("base", "through=", None if base is None else base - 1)):
        for n in numbers(spark, f"{path}/{folder}", prefix, False):
            if last is not None and n <= last:
                store.delete(spark, f"{path}/{folder}/{prefix}{n}")
