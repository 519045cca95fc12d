"""The catalogue questions (a)-(g) and their variants, DataFrame form.

Each function takes the relation DataFrames it needs (so it runs on the
fixture relations, a parsed catalogue file or query tables alike) plus
parameters passed as literals, and returns a lazy DataFrame. Every top-k
has an explicit total order (SURVEY D16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import kth_by_counts, rank_slice, with_position
from tessera.operators.topk import (
    any_rows,
    arg_min,
    group_max_ties,
    kth_smallest,
    threshold_join,
    top_k,
    top_n_lists,
    top_n_per_group,
    top_n_with_ties,
)

REVIEW_COLS = ["Id", "ASIN", "group", "date", "customer", "rating", "votes", "helpful"]

# Tie-breaks after the question's own sort keys.
_REVIEW_TIES = ("date", "customer", "votes")


def _helpful_order(rating_desc: bool):
    r = F.col("rating").desc() if rating_desc else F.col("rating").asc()
    return [F.col("helpful").desc(), r] + [F.col(c).asc() for c in _REVIEW_TIES]


# (a) ------------------------------------------------------------------------

def most_helpful_reviews(reviews: DataFrame, product_id: str, rating_desc: bool = True,
                         k: int = 5) -> DataFrame:
    """Q-A1 / Q-A2: the k most helpful reviews of one product, highest
    (``rating_desc``) or lowest rating first among equally helpful ones."""
    one = reviews.filter(F.col("Id") == F.lit(product_id)).select(*REVIEW_COLS)
    return top_k(one, _helpful_order(rating_desc), k)


def most_helpful_reviews_all(reviews: DataFrame, rating_desc: bool = True, k: int = 5) -> DataFrame:
    """Q-A for every product at once: top k reviews per product."""
    return top_n_per_group(reviews.select(*REVIEW_COLS), ["Id"], _helpful_order(rating_desc), k)


# (b) ------------------------------------------------------------------------

def better_selling_similars(sells: DataFrame, similars: DataFrame,
                            product_id: str | None = None, own: DataFrame | None = None) -> DataFrame:
    """Q-B / JN-4: similar products that sell better (0 < rank < own rank).

    product -> (Id) similars -> (similar = ASIN) product, residual inequality
    on the two ranks. ``product_id=None`` answers it for every product.
    ``own`` binds the products asked about when the caller has filtered them
    (and ``similars``) by the numeric key at the scan.
    Output ``(Id, similar, salesrank_original, salesrank)``.
    """
    own = (sells if own is None else own).select("Id", F.col("salesrank").alias("salesrank_original"))
    sim = similars.select("Id", "similar")
    if product_id is not None:
        own = own.filter(F.col("Id") == F.lit(product_id))
        sim = sim.filter(F.col("Id") == F.lit(product_id))
    ranked = sells.filter(F.col("salesrank") > 0).select(F.col("ASIN").alias("similar"), "salesrank")
    return (own.join(sim, "Id")
               .join(ranked, "similar")
               .filter(F.col("salesrank") < F.col("salesrank_original"))
               .select("Id", "similar", "salesrank_original", "salesrank"))


def similars_in_catalog(similars: DataFrame, sells: DataFrame) -> DataFrame:
    """JN-5 / FLT-4 / FLT-9: similar entries whose product is in the
    catalogue; a left-semi join instead of a collected key list."""
    keys = sells.select(F.col("ASIN").alias("similar"))
    return similars.join(keys, "similar", "left_semi").select("Id", "ASIN", "similar")


def similars_with_default_rank(similars: DataFrame, sells: DataFrame) -> DataFrame:
    """JN-6: similar entries with the similar product's rank, -1 when the
    similar product is not in the catalogue."""
    ranks = sells.select(F.col("ASIN").alias("similar"), F.col("salesrank").alias("similar_salesrank"))
    return (similars.join(ranks, "similar", "left")
                    .select("Id", "ASIN", "similar",
                            F.coalesce("similar_salesrank", F.lit(-1)).alias("similar_salesrank")))


def key_value_table(sells: DataFrame) -> DataFrame:
    """The key/value layout of the catalogue: ``<Id> -> ASIN`` and
    ``<ASIN>|salesrank -> rank`` as one ``(kind, key, value)`` relation; the
    ``kind`` lets a lookup drop the other branch."""
    by_id = sells.select(F.lit("asin").alias("kind"), F.col("Id").alias("key"), F.col("ASIN").alias("value"))
    by_asin = sells.select(F.lit("salesrank").alias("kind"), F.concat(F.col("ASIN"), F.lit("|salesrank")).alias("key"),
                           F.col("salesrank").cast("string").alias("value"))
    return by_id.unionByName(by_asin)


def id_lookup(similars: DataFrame, kv: DataFrame) -> DataFrame:
    """JN-7 / FLT-9: translate ``Id -> ASIN`` and ``similar -> rank`` through
    the key/value relation; a missing key drops the row (exists guard)."""
    asin = kv.filter("kind = 'asin'").select(F.col("key").alias("Id"), F.col("value").alias("own_asin"))
    rank = kv.filter("kind = 'salesrank'").select(F.col("key").alias("rank_key"),
                                         F.col("value").try_cast("int").alias("similar_salesrank"))
    return (similars.select("Id", "similar")
                    .join(asin, "Id")
                    .withColumn("rank_key", F.concat(F.col("similar"), F.lit("|salesrank")))
                    .join(rank, "rank_key")
                    .select("Id", F.col("own_asin").alias("ASIN"), "similar", "similar_salesrank"))


# (c) ------------------------------------------------------------------------

def daily_rating(reviews: DataFrame, product_id: str) -> DataFrame:
    """Q-C: daily mean rating of one product, by date."""
    return (reviews.filter(F.col("Id") == F.lit(product_id))
                   .groupBy("date").agg(F.avg("rating").alias("avgrating"))
                   .orderBy("date"))


def daily_rating_all(reviews: DataFrame) -> DataFrame:
    """Q-C-ALL / AGG-6: daily mean rating over all products."""
    return reviews.groupBy("date").agg(F.avg("rating").alias("avgrating")).orderBy("date")


def daily_partials(reviews: DataFrame) -> DataFrame:
    """AGG-12 (write side): per (Id, date) rating sum and count."""
    return reviews.groupBy("Id", "date").agg(
        F.sum("rating").cast("long").alias("total_rating"),
        F.count(F.lit(1)).alias("count_rating"))


def daily_rating_from_partials(partials: DataFrame) -> DataFrame:
    """AGG-12 (read side): finalise the stored partials to means."""
    return partials.select("Id", "date",
                           (F.col("total_rating") / F.col("count_rating")).alias("avgrating"))


# (d) ------------------------------------------------------------------------

_PRODUCT_COLS = ["group", "Id", "title", "salesrank"]


def top_sellers_rank(sells: DataFrame, n: int = 10) -> DataFrame:
    """Q-D: per group the products ranked <= n by salesrank (ties share a
    rank and are all kept), unranked products (0/-1) excluded."""
    ranked = sells.filter(F.col("salesrank") > 0).select(*_PRODUCT_COLS)
    return top_n_with_ties(ranked, ["group"], "salesrank", n)


def top_sellers_exact(sells: DataFrame, n: int = 10) -> DataFrame:
    """Q-D-EXACT / WIN-3: exactly n ranked products per group, tie by Id."""
    ranked = sells.filter(F.col("salesrank") > 0).select(*_PRODUCT_COLS)
    return top_n_per_group(ranked, ["group"], [F.col("salesrank").asc(), F.col("Id").asc()], n)


def top_sellers_best(sells: DataFrame) -> DataFrame:
    """Q-D-BEST / AGG-8: the single best-ranked product per group."""
    ranked = sells.filter(F.col("salesrank") > 0)
    return arg_min(ranked, ["group"], ["salesrank", "Id"], ["title"]).select(*_PRODUCT_COLS)


def group_rank_threshold(sells: DataFrame, n: int = 10) -> DataFrame:
    """AGG-13: per group the n-th smallest positive rank (largest if fewer)."""
    ranked = sells.filter(F.col("salesrank") > 0)
    return kth_smallest(ranked, ["group"], "salesrank", n, tie=["Id"])


def group_rank_threshold_deep(sells: DataFrame, n: int) -> DataFrame:
    """AGG-13 for any n: by counts per range of ranks, see ``kth_by_counts``."""
    return kth_by_counts(sells.filter(F.col("salesrank") > 0), ["group"], "salesrank", n)


def top_sellers_threshold(sells: DataFrame, n: int = 10) -> DataFrame:
    """JN-8 / FLT-6: Q-D answered through per-group thresholds."""
    return threshold_join(sells.select(*_PRODUCT_COLS), group_rank_threshold(sells, n), ["group"], "salesrank")


def any_products(sells: DataFrame, n: int = 10) -> DataFrame:
    """SRT-9: n arbitrary products (limit without order)."""
    return any_rows(sells.select(*_PRODUCT_COLS), n)


def any_products_counted(sells: DataFrame, n: int = 10) -> DataFrame:
    """What is defined about SRT-9: how many rows come, and how many of them
    are products."""
    some = any_products(sells, n).select("Id")
    known = sells.select("Id", F.lit(1).alias("known"))
    return some.join(known, "Id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("found"))


def product_groups(sells: DataFrame) -> DataFrame:
    """AGG-10: the distinct groups."""
    return sells.select("group").distinct()


# (e) ------------------------------------------------------------------------

def helpful_means(reviews: DataFrame) -> DataFrame:
    """AGG-4: mean helpful votes per product."""
    return reviews.groupBy("Id").agg(F.avg("helpful").alias("avghelpful"))


def top_helpful_products(reviews: DataFrame, sells: DataFrame, k: int = 10) -> DataFrame:
    """Q-E: the k products with the highest mean helpful votes, with ASIN and
    title; ties by Id."""
    order = [F.col("avghelpful").desc(), F.col("Id").asc()]
    best = top_k(helpful_means(reviews).join(sells.select("Id"), "Id", "left_semi"), order, k)
    joined = best.join(sells.select("Id", "ASIN", "title"), "Id")
    return joined.select("Id", "ASIN", "title", "avghelpful").orderBy(*order)


# (f) ------------------------------------------------------------------------

def _product_helpful_sums(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("Id").agg(F.sum("helpful").cast("long").alias("hsum"),
                                     F.count(F.lit(1)).alias("hcount"))


def category_helpful_means(reviews: DataFrame, categories: DataFrame) -> DataFrame:
    """AGG-14: mean helpful votes over the reviews of each category.

    Reviews are pre-aggregated per product (sum, count) before the join, so
    the join moves one row per product instead of one per review; a path
    repeated inside one product counts once (distinct).
    """
    cats = categories.select("Id", "category").distinct()
    return (_product_helpful_sums(reviews).join(cats, "Id")
            .groupBy("category")
            .agg((F.sum("hsum") / F.sum("hcount")).alias("avghelpful")))


def top_categories(reviews: DataFrame, categories: DataFrame, k: int = 5) -> DataFrame:
    """Q-F: the k categories with the highest mean helpful votes."""
    return top_k(category_helpful_means(reviews, categories),
                 [F.col("avghelpful").desc(), F.col("category").asc()], k)


def top_categories_by_product(reviews: DataFrame, categories: DataFrame, k: int = 5) -> DataFrame:
    """Q-F option: categories ranked by the mean of their products' means."""
    cats = categories.select("Id", "category").distinct()
    # A mean of doubles depends on summation order in its last bits; it is
    # reported to 10 decimals so every engine and partitioning agrees.
    means = (helpful_means(reviews).join(cats, "Id")
             .groupBy("category").agg(F.round(F.avg("avghelpful"), 10).alias("avghelpful")))
    return top_k(means, [F.col("avghelpful").desc(), F.col("category").asc()], k)


# (g) ------------------------------------------------------------------------

def reviews_per_customer(reviews: DataFrame) -> DataFrame:
    """AGG-7: review count per (group, customer)."""
    return reviews.groupBy("group", "customer").agg(F.count(F.lit(1)).alias("comments"))


def reviews_by_customer(reviews: DataFrame) -> DataFrame:
    """SRT-4: review count per customer, over all groups."""
    return reviews.groupBy("customer").agg(F.count(F.lit(1)).alias("comments"))


def customer_positions(reviews: DataFrame) -> DataFrame:
    """SRT-10: every customer's place among all customers, most reviews
    first, customer ascending on ties."""
    return with_position(reviews_by_customer(reviews), [F.col("comments").desc(), "customer"])


def middle_customers(reviews: DataFrame, descending: bool, around: int = 5) -> DataFrame:
    """SRT-6 deep in a ranking: the customers at and next to the middle of
    all customers by review count, with counts and positions (from 0)."""
    counts = reviews_by_customer(reviews)
    middle = counts.count() // 2
    return rank_slice(counts, "comments", "customer", max(0, middle - around), middle + around, descending)


def top_reviewers(reviews: DataFrame, n: int = 10) -> DataFrame:
    """Q-G: per group the n customers with most reviews (customer asc on ties)."""
    return top_n_per_group(reviews_per_customer(reviews), ["group"],
                           [F.col("comments").desc(), F.col("customer").asc()], n)


def top_reviewers_ties(reviews: DataFrame) -> DataFrame:
    """Q-G-MAX: every customer tied at the group's maximum review count."""
    return group_max_ties(reviews_per_customer(reviews), ["group"], "comments")


def reviewers_additive(reviews: DataFrame) -> DataFrame:
    """AGG-15: per product partial counters summed across products."""
    per_product = reviews.groupBy("group", "customer", "Id").agg(F.count(F.lit(1)).alias("n"))
    return per_product.groupBy("group", "customer").agg(F.sum("n").cast("long").alias("comments"))


def reviewers_distinct_products(reviews: DataFrame, n: int = 10) -> DataFrame:
    """AGG-16: per group the n customers who reviewed most distinct products."""
    counts = reviews.groupBy("group", "customer").agg(F.countDistinct("Id").alias("products"))
    return top_n_per_group(counts, ["group"], [F.col("products").desc(), F.col("customer").asc()], n)


def top_reviewers_lists(reviews: DataFrame, n: int = 10) -> DataFrame:
    """AGG-9: per group one ordered list of its n most active customers,
    rendered as ``customer:count`` items joined by commas. The list is
    built from the rows kept by the per-group limit only (at most n)."""
    lists = top_n_lists(reviews_per_customer(reviews), ["group"],
                        [F.col("comments").desc(), F.col("customer").asc()], n, ["customer", "comments"])
    items = F.transform("items", lambda x: F.concat_ws(":", x["customer"], x["comments"].cast("string")))
    return lists.select("group", F.concat_ws(",", items).alias("top_customers"))
