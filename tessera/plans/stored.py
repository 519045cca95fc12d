"""Stored tables kept up to date: refreshed, upserted and corrected by batches
that are cut from the tables, each then read back whole.

The batches are thirds of the reviews by a hash of the customer, so that they
share products, days and groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import questions as Q
from tessera.session import scratch_dir
from tessera.sinks import keyed_table, partials
from tessera.sinks.catalog_text import write_catalog_text
from tessera.sources import catalog as C
from tessera.streaming.corrections import compact_counters, corrected_counters, start_corrected_counters
from tessera.streaming.top_lists import start_top_reviewers, top_reviewers_now

BATCHES = 3


def _third(n: int) -> Column:
    return F.pmod(F.xxhash64("customer"), F.lit(BATCHES)) == n


def refreshed(spark: SparkSession, batches: list[DataFrame], keys, sums, cluster_by, order=()) -> DataFrame:
    """SNK-5 / AGG-12: one table of sums from several batches. The second is
    delivered twice, the base is folded before the last."""
    path = scratch_dir(spark, "refreshed")
    for i, batch in enumerate(batches):
        partials.add_batch(batch, path, i)
        if i == 1:
            partials.add_batch(batch, path, i)
            partials.compact(spark, path, keys, sums, cluster_by, order)
    return partials.merged(spark, path, keys, sums)


def daily_table_refreshed(spark, sf_dir):
    """The daily rating sums of each product, built by three batches."""
    reviews = C.reviews(spark, sf_dir, with_group=False)
    batches = [reviews.filter(_third(i)).groupBy("Id", "ASIN", "date").agg(
        F.sum("rating").cast("long").alias("total_rating"), F.count(F.lit(1)).alias("count_rating")) for i in range(BATCHES)]
    return refreshed(spark, batches, ["Id", "ASIN", "date"], ["total_rating", "count_rating"], ["Id"], [F.col("date").asc()])


def customer_table_refreshed(spark, sf_dir):
    """Reviews per group and customer, built by three batches; here they are
    cut by date, so that a customer occurs in several."""
    reviews = C.reviews(spark, sf_dir)
    year = F.year("date")
    cuts = [year < 1994, (year >= 1994) & (year < 1997), year >= 1997]
    batches = [reviews.filter(c).groupBy("group", "customer").agg(F.count(F.lit(1)).alias("total")) for c in cuts]
    return refreshed(spark, batches, ["group", "customer"], ["total"], ["group"], [F.col("total").desc(), F.col("customer").asc()])


def reviews_table_upserted(spark, sf_dir, buckets: int = 8):
    """SNK-7 on a stored table: reviews keyed by (Id, helpful, rating), the
    last line of a product's record wins. The table is created from one third
    of the reviews and updated with the others, one of them twice."""
    reviews = C.reviews(spark, sf_dir, with_group=False)
    wide = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    line = F.concat_ws("|", F.date_format("date", "yyyy-MM-dd"), "customer", wide("rating", 3), wide("votes", 10), wide("helpful", 10))
    rows = reviews.select("Id", "ASIN", "date", "customer", "rating", F.col("votes").alias("vote"), "helpful", line.alias("line"))
    path, thirds, key = scratch_dir(spark, "reviews-keyed"), scratch_dir(spark, "review-thirds"), ["Id", "helpful", "rating"]
    # dealt into the thirds in one pass: an update reads its own, and joins and shuffles no reviews of the others
    dealt = rows.withColumn("third", F.pmod(F.xxhash64("customer"), F.lit(BATCHES)).cast("int"))
    dealt.write.partitionBy("third").parquet(thirds)
    stored = spark.read.schema(dealt.schema).parquet(thirds)
    batch = lambda n: stored.filter(F.col("third") == n).drop("third")
    keyed_table.create(batch(1), path, key, "line", buckets)
    for third in (2, 0, 2):
        keyed_table.upsert(batch(third), path, key, "line", buckets)
    return keyed_table.read(spark, path).drop("line")


def _deliver(spark, path, sells, reviews, discontinued=None) -> None:
    none = F.lit(False)
    similars = sells.select("Id", "ASIN", F.lit("").alias("similar")).filter(none)
    categories = sells.select("Id", "ASIN", F.lit("").alias("category")).filter(none)
    write_catalog_text(spark, sells, similars, categories, reviews, path, discontinued=discontinued)


def review_counters_corrected(spark, sf_dir):
    """AGG-15 under corrections. The first delivery is right for a quarter of
    the products; the others lack a third of their reviews, some are in an
    old group, and products that no longer exist have reviews. The second
    delivers the others anew, some right ones unchanged, and the discontinued
    products. What is counted then is the catalogue."""
    src, table, state = (scratch_dir(spark, n) for n in ("deliveries", "counters", "counters-state"))
    sells, reviews = C.sells(spark, sf_dir), C.reviews(spark, sf_dir, with_group=False)
    number = F.col("Id").cast("long")
    right, same = number % 4 == 3, number % 8 == 3
    old_group = sells.withColumn("group", F.when(~right & (number % 5 == 0), F.lit("old")).otherwise(F.col("group")))
    gone_id = F.concat(F.lit("9"), F.lpad("Id", 12, "0"))
    gone = sells.filter(number % 20 == 0).withColumn("Id", gone_id)
    gone_reviews = reviews.filter(number % 20 == 0).withColumn("Id", gone_id)
    _deliver(spark, f"{src}/first", old_group.unionByName(gone), reviews.filter(right | ~_third(0)).unionByName(gone_reviews))
    start_corrected_counters(spark, f"{src}/*", table, state).awaitTermination()
    compact_counters(spark, table)
    anew = ~right | same
    _deliver(spark, f"{src}/second", sells.filter(anew), reviews.filter(anew), gone.select("Id", "ASIN"))
    start_corrected_counters(spark, f"{src}/*", table, state).awaitTermination()
    return corrected_counters(spark, table)


def top_reviewers_corrected(spark, sf_dir, n: int = 10):
    """Q-G answered from the corrected counters."""
    return Q.top_n_per_group(review_counters_corrected(spark, sf_dir), ["group"], [F.col("comments").desc(), F.col("customer").asc()], n)


def top_reviewers_streamed(spark, sf_dir, n: int = 10):
    """WIN-3 kept up to date: the catalogue is delivered in three deliveries,
    one micro-batch after the other; what is read is the last list."""
    src, top, state = (scratch_dir(spark, x) for x in ("deliveries", "top-lists", "top-state"))
    sells, reviews = C.sells(spark, sf_dir), C.reviews(spark, sf_dir, with_group=False)
    for i in range(BATCHES):
        own = F.pmod(F.xxhash64("Id"), F.lit(BATCHES)) == i
        _deliver(spark, f"{src}/{i}", sells.filter(own), reviews.filter(own))
        start_top_reviewers(spark, f"{src}/*", top, n, state).awaitTermination()
    return top_reviewers_now(spark, top)
