"""Catalogue relations derived from the driver tables.

The catalogue questions run on five relations (explicit schemas, never
inferred):

    sells(Id, ASIN, title, group, salesrank, categories)
    similars(Id, ASIN, similar)
    categories(Id, ASIN, category)
    reviews(Id, ASIN, group, date, customer, rating, votes, helpful)
    review_stats(Id, total, downloaded, avg_rating)

They are projections and joins of ``part``, ``lineitem`` and ``orders``, so
their size grows with the tables. Every builder returns a lazy DataFrame;
Catalyst prunes the columns a question does not use. Joins are only added
when a column needs them (``reviews(with_group=False)`` reads lineitem only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table

# Fixed values of the mapping from driver tables to catalogue fields.
ASIN_PREFIX = "P"
ASIN_DIGITS = 9
RANK_BASE_PRICE = 900.0
# Similar products: up to four key offsets, how many is p_size % 5, plus one
# dangling "X<Id>" entry (a similar product that is not in the catalogue)
# when p_size % 3 == 0. Every product has at most five similars, so the
# relation grows linearly with ``part`` (no pairs within a group).
SIMILAR_OFFSETS = (37, 911, 173, 619)
SIMILAR_MODULUS = 5
DANGLING_MODULUS = 3


def asin_of(id_col: Column) -> Column:
    return F.concat(F.lit(ASIN_PREFIX), F.lpad(id_col, ASIN_DIGITS, "0"))


def _part(spark: SparkSession, sf_dir: str, product_id: str | None = None) -> DataFrame:
    """``part``; with ``product_id`` only that product, by its numeric key, so
    that the filter reaches the scan."""
    p = table(spark, sf_dir, "part")
    return p if product_id is None else p.filter(F.col("p_partkey") == F.lit(product_id).try_cast("long"))


def sells(spark: SparkSession, sf_dir: str, product_id: str | None = None) -> DataFrame:
    """SRC-5: one row per product. ``salesrank`` keeps the sentinels 0/-1."""
    p = _part(spark, sf_dir, product_id)
    pid = F.col("p_partkey").cast("string")
    return p.select(
        pid.alias("Id"),
        asin_of(pid).alias("ASIN"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("group"),
        (F.round((F.col("p_retailprice") - F.lit(RANK_BASE_PRICE)) * 10).cast("int") - 1).alias("salesrank"),
        F.lit(3).alias("categories"),
    )


def similar_list(p: DataFrame) -> Column:
    """``array<string>`` of similar ASINs of each part row."""
    key = F.col("p_partkey")
    n = (F.col("p_size") % SIMILAR_MODULUS).cast("int")
    near = F.slice(F.array(*[asin_of((key + F.lit(d)).cast("string")) for d in SIMILAR_OFFSETS]), 1, n)
    dangling = F.when(F.col("p_size") % DANGLING_MODULUS == 0,
                      F.array(F.concat(F.lit("X"), key.cast("string")))
                      ).otherwise(F.array().cast("array<string>"))
    return F.concat(near, dangling)


def similars(spark: SparkSession, sf_dir: str, product_id: str | None = None) -> DataFrame:
    """SRC-6: ``(Id, ASIN, similar)``, one row per listed similar product."""
    p = _part(spark, sf_dir, product_id)
    pid = F.col("p_partkey").cast("string")
    return p.select(pid.alias("Id"), asin_of(pid).alias("ASIN"),
                    F.explode(similar_list(p)).alias("similar"))


def category_list() -> Column:
    """Three category paths per part: type, type|brand, size|n."""
    return F.array(
        F.col("p_type"),
        F.concat_ws("|", F.col("p_type"), F.col("p_brand")),
        F.concat(F.lit("size|"), F.col("p_size").cast("string")),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: ``(Id, ASIN, category)``."""
    p = _part(spark, sf_dir)
    pid = F.col("p_partkey").cast("string")
    return p.select(pid.alias("Id"), asin_of(pid).alias("ASIN"),
                    F.explode(category_list()).alias("category"))


def _review_fields() -> list[Column]:
    q = F.col("l_quantity").cast("int")
    return [
        F.col("l_shipdate").cast("date").alias("date"),
        (F.lit(1) + q % 5).alias("rating"),
        q.alias("votes"),
        F.floor(q * F.round(F.col("l_discount") * 100).cast("int") / 10).cast("int").alias("helpful"),
    ]


def reviews(spark: SparkSession, sf_dir: str, with_group: bool = True,
            with_customer: bool = True, product_id: str | None = None) -> DataFrame:
    """SRC-7: one row per review (a lineitem).

    ``with_group`` / ``with_customer`` add the join to ``part`` / ``orders``
    only when the column is needed. Leaving a join out is exact because every
    lineitem has its order and its part (foreign keys of the TPC-H-style
    tables; checked by the oracles, which always join): it is the join
    elimination Catalyst would do itself if the keys were declared.

    ``product_id`` filters on the numeric key before any join, so the
    predicate reaches the lineitem scan (PushedFilters) instead of running on
    the string ``Id`` after the joins.
    """
    li = table(spark, sf_dir, "lineitem")
    if product_id is not None:
        li = li.filter(F.col("l_partkey") == F.lit(product_id).try_cast("long"))
    pid = F.col("l_partkey").cast("string")
    cols = [pid.alias("Id"), asin_of(pid).alias("ASIN")]
    if with_group:
        p = _part(spark, sf_dir, product_id).select("p_partkey", F.col("p_type").alias("group"))
        # a product with a third of all reviews is split by adaptive execution
        li = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
        cols.append(F.col("group"))
    if with_customer:
        o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
        li = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    fields = _review_fields()
    out = cols + [fields[0]]
    if with_customer:
        out.append(F.col("customer"))
    out += fields[1:]
    return li.select(*out)


def review_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: per product review header (total, downloaded, avg rating).

    ``avg_rating`` is rounded to one decimal, as printed in the text form.
    """
    r = reviews(spark, sf_dir, with_group=False, with_customer=False)
    return r.groupBy("Id").agg(
        F.count(F.lit(1)).cast("int").alias("total"),
        F.count(F.lit(1)).cast("int").alias("downloaded"),
        F.round(F.avg("rating"), 1).alias("avg_rating"),
    )
