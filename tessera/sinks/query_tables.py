"""Precomputed query tables (SNK-5): one table per question, laid out in
answer order so a question becomes a pruned scan.

Layout: a range shuffle on the clustering key gives every output file a
disjoint key range, and a sort inside each file puts rows in answer order.
Parquet keeps min/max statistics per row group, so ``key = x`` skips every
file and row group that cannot hold ``x``. Low-cardinality keys (a product
group) can additionally be directory partitions (``partition_by``); a
high-cardinality key (a product Id) never is, to avoid one folder per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_query_table(df: DataFrame, path: str, cluster_by: Sequence[str],
                      order: Sequence[Column] = (), partition_by: Sequence[str] = (),
                      partitions: int | None = None, mode: str = "overwrite", look_up: Sequence[str] = ()) -> None:
    """``look_up`` names columns that rows are also looked up by: each gets
    Parquet Bloom filters, sized per row group by the writer, so that an
    equality on it skips the row groups that can't hold the value although
    the table is clustered by another key."""
    keys = list(partition_by) + [c for c in cluster_by if c not in partition_by]
    cols = [F.col(c) for c in keys]
    # The range key continues with the in-file order, so one clustering key
    # holding a third of all rows is cut into several ranges (files) by its
    # order values instead of going to a single writer task; min/max stats
    # still prune by key. Without an explicit count AQE sizes the range
    # shuffle from the data.
    range_key = [*cols, *order]
    ranged = df.repartitionByRange(partitions, *range_key) if partitions else df.repartitionByRange(*range_key)
    out = ranged.sortWithinPartitions(*cols, *order)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for c in look_up:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(path)


def read_query_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# -- the per-question tables ------------------------------------------------------
# name -> (builder, cluster_by, order, partition_by). Builders take the
# relations (sells, similars, reviews) and return the table's rows.

def _products(sells, similars, reviews):
    return sells.select("Id", "ASIN", "title", "group", "salesrank")


def _similars(sells, similars, reviews):
    ranks = sells.select(F.col("ASIN").alias("similar"), F.col("salesrank").alias("similarsales"))
    return (similars.join(sells.select("Id", "salesrank"), "Id")
            .join(ranks, "similar", "left")
            .select("Id", "ASIN", "similar", "salesrank",
                    F.coalesce("similarsales", F.lit(-1)).alias("similarsales")))


def _reviews_v1(sells, similars, reviews):
    return reviews.select("Id", "ASIN", "date", "customer", "rating", F.col("votes").alias("vote"), "helpful")


def _reviews_v2(sells, similars, reviews):
    return reviews.groupBy("Id", "ASIN", "date").agg(
        F.sum("rating").cast("long").alias("total_rating"), F.count(F.lit(1)).alias("count_rating"))


def _groups(sells, similars, reviews):
    return sells.filter(F.col("salesrank") > 0).select("group", "Id", "ASIN", "salesrank")


def _customer_reviews(sells, similars, reviews):
    return reviews.groupBy("group", "customer").agg(F.count(F.lit(1)).alias("total"))


QUESTION_TABLES = {
    "products": (_products, ["Id"], ["salesrank"], []),
    "similars": (_similars, ["Id"], ["salesrank", "similarsales"], []),
    "reviews_v1": (_reviews_v1, ["Id"], [("helpful", "desc"), ("rating", "desc")], []),
    "reviews_v2": (_reviews_v2, ["Id"], ["date"], []),
    "groups": (_groups, ["salesrank"], ["salesrank", "Id"], ["group"]),
    "customer_reviews": (_customer_reviews, [], [("total", "desc"), "customer"], ["group"]),
}


# Columns besides the clustering key that questions look rows up by.
LOOK_UP = {"products": ["ASIN"], "similars": ["ASIN", "similar"], "reviews_v1": ["ASIN"], "reviews_v2": ["ASIN"], "groups": ["ASIN"]}


def _order(spec) -> list[Column]:
    out = []
    for o in spec:
        if isinstance(o, tuple):
            out.append(F.col(o[0]).desc() if o[1] == "desc" else F.col(o[0]).asc())
        else:
            out.append(F.col(o).asc())
    return out


def write_question_table(name: str, path: str, sells: DataFrame, similars: DataFrame,
                         reviews: DataFrame) -> None:
    build, cluster_by, order, partition_by = QUESTION_TABLES[name]
    write_query_table(build(sells, similars, reviews), path, cluster_by=cluster_by,
                      order=_order(order), partition_by=partition_by, look_up=LOOK_UP.get(name, ()))


def write_bucketed(df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Store ``df`` as a table bucketed and sorted on ``key`` (files under
    ``path``) and return it read back.

    Tables bucketed on the same key into the same number of buckets join
    and aggregate on that key without any shuffle: the relation that every
    question joins (reviews by product, orders by order key) is bucketed
    once and each later query reads it co-located.
    """
    (df.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
