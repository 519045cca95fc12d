"""Plan shape of the registered queries: the properties the scale design
relies on, read from the executed physical plan."""

import re

import pytest

from tessera.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def _plan(spark, key) -> str:
    df = QUERIES[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def _static_plans(spark):
    # Read the plan Catalyst chose, before AQE re-plans at run time.
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def _ops_in_order(plan: str) -> list[str]:
    return re.findall(r"(HashAggregate|SortAggregate|Exchange|WindowGroupLimit|Window|"
                      r"SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|TakeOrderedAndProject|"
                      r"CartesianProduct|BroadcastNestedLoopJoin)", plan)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_products(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["wordcount", "wordcount_alpha", "top_reviewers", "reviewers_additive",
                                 "daily_rating_all", "top_categories", "top_helpful_products"])
def test_partial_aggregate_below_first_aggregate_exchange(spark, key):
    plan = _plan(spark, key)
    assert "partial_" in plan, plan


@pytest.mark.parametrize("key", ["top_sellers_rank", "top_sellers_exact", "top_sellers_sql", "top_reviewers",
                                 "reviews_most_helpful_high_all",
                                 "reviewers_distinct_products", "bucket_first_and_third_last",
                                 "group_rank_threshold"])
def test_group_limit_before_the_window_shuffle(spark, key):
    plan = _plan(spark, key)
    assert "WindowGroupLimit" in plan and "Partial" in plan, plan


@pytest.mark.parametrize("key", ["latest_by_key", "top_sellers_best", "top_reviewers_ties", "top_reviewers_ties_sql"])
def test_no_window_for_per_key_winner(spark, key):
    assert "Window" not in _plan(spark, key)


def test_category_means_aggregate_before_the_join(spark):
    ops = _ops_in_order(_plan(spark, "top_categories"))
    # top-down: the review side is aggregated (per product) below the join
    join_at = next(i for i, o in enumerate(ops) if o.endswith("Join"))
    assert "HashAggregate" in ops[join_at + 1:]


def test_top_k_questions_use_bounded_take(spark):
    for key in ["reviews_most_helpful_high", "top_helpful_products", "top_categories", "leaderboard_slice"]:
        assert "TakeOrderedAndProject" in _plan(spark, key), key


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "top_helpful_products")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_comment" not in s and "l_tax" not in s for s in schemas)
    lineitem = [s for s in schemas if "l_partkey" in s]
    assert lineitem and all("l_shipdate" not in s for s in lineitem)


def test_upserted_reviews_are_shuffled_once_as_records(spark):
    plan = _plan(spark, "reviews_upserted")
    assert plan.count("Exchange hashpartitioning(") == 1, plan
    below = plan[plan.index("Exchange hashpartitioning(Id#"):]
    assert "Aggregate" not in below and "Sort" not in below and "Generate" not in below, plan
