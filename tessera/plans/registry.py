"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the driver tables (or files Spark derives from them)
in full; product-specific questions take the product Id as a parameter,
which is the question itself, not a sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.format import two_decimals
from tessera.operators.aggregates import numeric_means
from tessera.operators.upsert import latest_by_key
from tessera.plans import catalog_files as CF
from tessera.plans import oracle as O
from tessera.plans import questions as Q
from tessera.plans import sql as S
from tessera.plans import stored as ST
from tessera.plans import wordcount as W
from tessera.sinks.query_tables import QUESTION_TABLES
from tessera.sources import catalog as C

Query = Callable[[SparkSession, str], DataFrame]


def _reviews(spark, d, **kw):
    return C.reviews(spark, d, **kw)


QUERIES: dict[str, Query] = {
    # word count
    "wordcount": lambda s, d: W.wordcount(s, d),
    "wordcount_alpha": lambda s, d: W.wordcount(s, d, alpha_only=True),
    "unique_terms": lambda s, d: W.unique_terms(s, d),
    "unique_terms_alpha": lambda s, d: W.unique_terms(s, d, alpha_only=True),
    "term_buckets": lambda s, d: W.term_buckets(s, d),
    "bucket_first_and_third_last": lambda s, d: W.bucket_first_and_third_last(s, d),
    "bucket_first_and_third_last_alpha": lambda s, d: W.bucket_first_and_third_last(s, d, alpha_only=True),
    "wordcount_tsv_roundtrip": lambda s, d: W.wordcount_tsv_roundtrip(s, d),
    "part_edges_from_files": lambda s, d: W.part_edges_from_files(s, d),
    "part_edges_from_files_alpha": lambda s, d: W.part_edges_from_files(s, d, alpha_only=True),
    # (a)
    "reviews_most_helpful_high": lambda s, d: Q.most_helpful_reviews(
        _reviews(s, d, product_id=O.REVIEW_ID), O.REVIEW_ID, rating_desc=True),
    "reviews_most_helpful_low": lambda s, d: Q.most_helpful_reviews(
        _reviews(s, d, product_id=O.REVIEW_ID), O.REVIEW_ID, rating_desc=False),
    "reviews_most_helpful_high_sql": lambda s, d: S.most_helpful_reviews_sql(
        s, _reviews(s, d, product_id=O.REVIEW_ID)),
    "reviews_most_helpful_high_all": lambda s, d: Q.most_helpful_reviews_all(_reviews(s, d), rating_desc=True),
    "reviews_most_helpful_low_all": lambda s, d: Q.most_helpful_reviews_all(_reviews(s, d), rating_desc=False),
    # (b)
    "better_selling_similars": lambda s, d: Q.better_selling_similars(
        C.sells(s, d), C.similars(s, d, O.SIMILAR_ID), own=C.sells(s, d, O.SIMILAR_ID)),
    "better_selling_similars_all": lambda s, d: Q.better_selling_similars(C.sells(s, d), C.similars(s, d)),
    "better_selling_similars_sql": lambda s, d: S.better_selling_similars_sql(
        s, C.sells(s, d, O.SIMILAR_ID), C.similars(s, d, O.SIMILAR_ID), C.sells(s, d)),
    "similars_in_catalog": lambda s, d: Q.similars_in_catalog(C.similars(s, d), C.sells(s, d)),
    "similars_with_default_rank": lambda s, d: Q.similars_with_default_rank(C.similars(s, d), C.sells(s, d)),
    "id_lookup": lambda s, d: Q.id_lookup(C.similars(s, d), Q.key_value_table(C.sells(s, d))),
    # (c)
    "daily_rating": lambda s, d: Q.daily_rating(
        _reviews(s, d, with_group=False, with_customer=False, product_id=O.REVIEW_ID), O.REVIEW_ID),
    "daily_rating_sql": lambda s, d: S.daily_rating_sql(
        s, _reviews(s, d, with_group=False, with_customer=False, product_id=O.REVIEW_ID)),
    "daily_rating_all": lambda s, d: Q.daily_rating_all(_reviews(s, d, with_group=False, with_customer=False)),
    "daily_rating_from_partials": lambda s, d: Q.daily_rating_from_partials(
        Q.daily_partials(_reviews(s, d, with_group=False, with_customer=False))),
    # (d)
    "top_sellers_rank": lambda s, d: Q.top_sellers_rank(C.sells(s, d)),
    "top_sellers_sql": lambda s, d: S.top_sellers_sql(s, C.sells(s, d)),
    "top_sellers_exact": lambda s, d: Q.top_sellers_exact(C.sells(s, d)),
    "top_sellers_best": lambda s, d: Q.top_sellers_best(C.sells(s, d)),
    "group_rank_threshold": lambda s, d: Q.group_rank_threshold(C.sells(s, d)),
    "group_rank_threshold_100": lambda s, d: Q.group_rank_threshold_deep(C.sells(s, d), 100),
    "group_rank_threshold_1000": lambda s, d: Q.group_rank_threshold_deep(C.sells(s, d), 1000),
    "top_sellers_threshold": lambda s, d: Q.top_sellers_threshold(C.sells(s, d)),
    "product_groups": lambda s, d: Q.product_groups(C.sells(s, d)),
    # (e)
    "top_helpful_products": lambda s, d: Q.top_helpful_products(
        _reviews(s, d, with_group=False, with_customer=False), C.sells(s, d)),
    "top_helpful_products_sql": lambda s, d: S.top_helpful_products_sql(
        s, _reviews(s, d, with_group=False, with_customer=False), C.sells(s, d)),
    "leaderboard_slice": lambda s, d: _leaderboard(s, d),
    "customer_positions": lambda s, d: Q.customer_positions(_reviews(s, d, with_group=False)),
    "customers_middle_desc": lambda s, d: Q.middle_customers(_reviews(s, d, with_group=False), descending=True),
    "customers_middle_asc": lambda s, d: Q.middle_customers(_reviews(s, d, with_group=False), descending=False),
    # (f)
    "top_categories": lambda s, d: Q.top_categories(
        _reviews(s, d, with_group=False, with_customer=False), C.categories(s, d)),
    "top_categories_by_product": lambda s, d: Q.top_categories_by_product(
        _reviews(s, d, with_group=False, with_customer=False), C.categories(s, d)),
    # (g)
    "top_reviewers": lambda s, d: Q.top_reviewers(_reviews(s, d)),
    "top_reviewers_ties": lambda s, d: Q.top_reviewers_ties(_reviews(s, d)),
    "top_reviewers_ties_sql": lambda s, d: S.top_reviewers_ties_sql(s, _reviews(s, d)),
    "top_reviewers_lists": lambda s, d: Q.top_reviewers_lists(_reviews(s, d)),
    "reviewers_additive": lambda s, d: Q.reviewers_additive(_reviews(s, d)),
    "reviewers_distinct_products": lambda s, d: Q.reviewers_distinct_products(_reviews(s, d)),
    # catalogue text / nested / packed forms
    "catalog_roundtrip_sells": CF.roundtrip_sells,
    "catalog_roundtrip_similars": CF.roundtrip_similars,
    "catalog_roundtrip_reviews": CF.roundtrip_reviews,
    "catalog_roundtrip_categories": CF.roundtrip_categories,
    "catalog_roundtrip_stats": CF.roundtrip_stats,
    "nested_products_flattened": CF.nested_products_flattened,
    "packed_reviews_roundtrip": CF.packed_reviews_roundtrip,
    "reviews_upserted": CF.reviews_upserted,
    # sinks
    "csv_roundtrip": CF.csv_roundtrip,
    "csv_single_file_top_sellers": CF.csv_single_file_top_sellers,
    "query_table_roundtrip": lambda s, d: CF.query_table_roundtrip(s, d, O.REVIEW_ID),
    "daily_partials_table": lambda s, d: CF.daily_partials_table(s, d, O.REVIEW_ID),
    "latest_by_key": lambda s, d: latest_by_key(
        C.table(s, d, "events").select("user_id", "event_type", "event_id", "ts", "value", "props"),
        ["user_id", "event_type"], "event_id"),
    "top_sellers_from_query_table": CF.top_sellers_from_query_table,
    "top_reviewers_from_query_table": CF.top_reviewers_from_query_table,
    "better_similars_from_query_table": CF.better_similars_from_query_table,
    "wordcount_text_files": CF.wordcount_text_files,
    **{f"query_table_{n}": CF.question_table(n) for n in QUESTION_TABLES},
    # stored tables kept up to date by batches
    "daily_table_refreshed": ST.daily_table_refreshed,
    "customer_table_refreshed": ST.customer_table_refreshed,
    "reviews_table_upserted": ST.reviews_table_upserted,
    "review_counters_corrected": ST.review_counters_corrected,
    "top_reviewers_corrected": ST.top_reviewers_corrected,
    "catalog_parsed_once": CF.parsed_once,
    "output_replaced": CF.output_replaced,
    "output_published": CF.output_published,
    "similars_looked_up": CF.similars_looked_up,
    "products_by_asin": lambda s, d: CF.products_by_asin(s, d, O.SIMILAR_ID),
    "top_reviewers_streamed": ST.top_reviewers_streamed,
    # order, made visible as columns
    "terms_sorted_in_files": CF.terms_sorted_in_files,
    "best_sellers_report": CF.best_sellers_report,
    "daily_rating_report": CF.daily_rating_report,
    # generic aggregates and formats, a named view
    "daily_numeric_means": lambda s, d: numeric_means(
        _reviews(s, d, with_group=False, with_customer=False).select("date", "rating", "votes", "helpful"), ["date"]),
    "daily_rating_printed": lambda s, d: Q.daily_rating_all(_reviews(s, d, with_group=False, with_customer=False)).select(
        "date", two_decimals("avgrating").alias("avgrating")),
    "select_all": lambda s, d: S.select_all(s, C.sells(s, d)),
    # sampling
    "any_products": lambda s, d: Q.any_products_counted(C.sells(s, d)),
}


def _leaderboard(spark, d):
    from tessera.operators.topk import slice_by_rank
    r = _reviews(spark, d, with_group=False, with_customer=False)
    scores = r.groupBy(F.col("ASIN").alias("member")).agg(F.avg("helpful").alias("score"))
    return slice_by_rank(scores, "score", "member", 0, 10, descending=True)


ORACLE: dict[str, str] = {
    "wordcount": O.WORDCOUNT,
    "wordcount_alpha": O.WORDCOUNT_ALPHA,
    "unique_terms": O.UNIQUE_TERMS,
    "unique_terms_alpha": O.UNIQUE_TERMS_ALPHA,
    "term_buckets": O.TERM_BUCKETS,
    "bucket_first_and_third_last": O._edges(False),
    "bucket_first_and_third_last_alpha": O._edges(True),
    "wordcount_tsv_roundtrip": O.WORDCOUNT,
    "part_edges_from_files": O._edges(False),
    "part_edges_from_files_alpha": O._edges(True),
    "reviews_most_helpful_high": O.REVIEWS_HIGH,
    "reviews_most_helpful_low": O.REVIEWS_LOW,
    "reviews_most_helpful_high_all": O.REVIEWS_HIGH_ALL,
    "reviews_most_helpful_low_all": O.REVIEWS_LOW_ALL,
    "better_selling_similars": O.BETTER_SIMILARS,
    "better_selling_similars_all": O.BETTER_SIMILARS_ALL,
    "better_selling_similars_sql": O.BETTER_SIMILARS_SQL,
    "similars_in_catalog": O.SIMILARS_IN_CATALOG,
    "similars_with_default_rank": O.SIMILARS_DEFAULT_RANK,
    "id_lookup": O.ID_LOOKUP,
    "daily_rating": O.DAILY_RATING,
    "daily_rating_all": O.DAILY_RATING_ALL,
    "daily_rating_from_partials": O.DAILY_RATING_PARTIALS,
    "top_sellers_rank": O.TOP_SELLERS_RANK,
    "top_sellers_sql": O.TOP_SELLERS_SQL,
    "top_sellers_exact": O.TOP_SELLERS_EXACT,
    "top_sellers_best": O.TOP_SELLERS_BEST,
    "group_rank_threshold": O.GROUP_RANK_THRESHOLD,
    "group_rank_threshold_100": O.group_rank_threshold(100),
    "group_rank_threshold_1000": O.group_rank_threshold(1000),
    "top_sellers_threshold": O.TOP_SELLERS_THRESHOLD,
    "product_groups": O.PRODUCT_GROUPS,
    "top_helpful_products": O.TOP_HELPFUL,
    "leaderboard_slice": O.LEADERBOARD_SLICE,
    "customer_positions": O.CUSTOMER_POSITIONS,
    "customers_middle_desc": O.middle_customers("DESC"),
    "customers_middle_asc": O.middle_customers("ASC"),
    "top_categories": O.TOP_CATEGORIES,
    "top_categories_by_product": O.TOP_CATEGORIES_BY_PRODUCT,
    "top_reviewers": O.TOP_REVIEWERS,
    "top_reviewers_ties": O.TOP_REVIEWERS_TIES,
    "top_reviewers_ties_sql": O.TOP_REVIEWERS_TIES,
    "top_reviewers_lists": O.TOP_REVIEWERS_LISTS,
    "reviewers_additive": O.REVIEWERS_ADDITIVE,
    "reviewers_distinct_products": O.REVIEWERS_DISTINCT,
    "catalog_roundtrip_sells": O.ROUNDTRIP_SELLS,
    "catalog_roundtrip_similars": O.ROUNDTRIP_SIMILARS,
    "catalog_roundtrip_reviews": O.ROUNDTRIP_REVIEWS,
    "catalog_roundtrip_categories": O.ROUNDTRIP_CATEGORIES,
    "catalog_roundtrip_stats": O.ROUNDTRIP_STATS,
    "nested_products_flattened": O.NESTED_FLATTENED,
    "packed_reviews_roundtrip": O.PACKED_REVIEWS,
    "reviews_upserted": O.REVIEWS_UPSERTED,
    "csv_roundtrip": O.ROUNDTRIP_SELLS,
    "csv_single_file_top_sellers": O.TOP_SELLERS_EXACT,
    "query_table_roundtrip": O.REVIEWS_HIGH,
    "daily_partials_table": O.DAILY_RATING,
    "latest_by_key": O.LATEST_BY_KEY,
    "top_sellers_from_query_table": O.TOP_SELLERS_FROM_TABLE,
    "reviews_most_helpful_high_sql": O.REVIEWS_HIGH,
    "daily_rating_sql": O.DAILY_RATING,
    "top_helpful_products_sql": O.TOP_HELPFUL,
    "top_reviewers_from_query_table": O.TOP_REVIEWERS,
    "better_similars_from_query_table": O.BETTER_SIMILARS_ALL,
    "wordcount_text_files": O.WORDCOUNT,
    **O.QUESTION_TABLES,
    "daily_table_refreshed": O.QUESTION_TABLES["query_table_reviews_v2"],
    "customer_table_refreshed": O.QUESTION_TABLES["query_table_customer_reviews"],
    "reviews_table_upserted": O.REVIEWS_UPSERTED,
    "review_counters_corrected": O.REVIEWERS_ADDITIVE,
    "top_reviewers_corrected": O.TOP_REVIEWERS,
    "catalog_parsed_once": O.PARSED_ONCE,
    "output_replaced": O.WORDCOUNT_ALPHA,
    "output_published": O.WORDCOUNT_ALPHA,
    "similars_looked_up": O.SIMILARS_LOOKED_UP,
    "products_by_asin": O.PRODUCTS_BY_ASIN,
    "top_reviewers_streamed": O.TOP_REVIEWERS,
    "terms_sorted_in_files": O.TERMS_SORTED,
    "best_sellers_report": O.BEST_SELLERS_REPORT,
    "daily_rating_report": O.DAILY_RATING_REPORT,
    "daily_numeric_means": O.DAILY_NUMERIC_MEANS,
    "daily_rating_printed": O.DAILY_RATING_PRINTED,
    "select_all": O.ROUNDTRIP_SELLS,
    "any_products": O.ANY_PRODUCTS,
}
