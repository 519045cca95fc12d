"""SQL form of the questions (SRC-12, JN-3).

Values are bound as named parameters (``args``); relations are bound as
DataFrames (``{sells}`` placeholders), which Spark registers under unique
names for the one statement, so concurrent queries never see each other's
relations. A relation that a question only needs for one product is bound
already filtered by its numeric key, so the filter reaches the scan.
``register`` exposes the relations under fixed view names for interactive SQL
(SRC-12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (a): the k most helpful reviews of the bound product, best rated first.
MOST_HELPFUL_REVIEWS = """
SELECT Id, ASIN, `group`, date, customer, rating, votes, helpful
FROM {reviews}
ORDER BY helpful DESC, rating DESC, date, customer, votes
LIMIT :k
"""

# (b), comma join over a FROM-subquery (JN-3). The subquery reduces the
# catalogue to what the bound product lists and what has a rank at all, before
# any rank is compared: the semi join carries two columns of few products.
BETTER_SELLING_SIMILARS = """
SELECT own.Id, better.ASIN AS similar, own.salesrank AS salesrank_original, better.salesrank
FROM {own} AS own, {listed} AS listed,
     (SELECT candidate.ASIN, candidate.salesrank
      FROM {sells} AS candidate LEFT SEMI JOIN {listed} AS entry ON entry.similar = candidate.ASIN
      WHERE candidate.salesrank > 0) AS better
WHERE listed.Id = own.Id AND listed.similar = better.ASIN AND better.salesrank < own.salesrank
"""

# (c): mean rating per day of the bound product, oldest day first.
DAILY_RATING = """
SELECT date, avg(rating) AS avgrating FROM {reviews} GROUP BY date ORDER BY date
"""

# (d), variant: fewer than n - 1 products of the group rank strictly better,
# that is, the rank is at most the (n - 1)-th smallest of the group. Only the
# limit's n - 1 rows of a group meet in a task, however many tie.
TOP_SELLERS = """
WITH lowest AS (
  SELECT `group`, salesrank, row_number() OVER (PARTITION BY `group` ORDER BY salesrank) AS place
  FROM {sells}),
bound AS (
  SELECT `group`, max(salesrank) AS worst FROM lowest WHERE place < :n GROUP BY `group`)
SELECT s.`group`, s.Id, s.title, s.salesrank
FROM {sells} AS s JOIN bound ON bound.`group` = s.`group` AND s.salesrank <= bound.worst
"""

# (e): the k products with the highest mean helpful votes among those in the
# catalogue; ASIN and title are looked up for the k rows only.
TOP_HELPFUL_PRODUCTS = """
WITH means AS (
  SELECT Id, avg(helpful) AS avghelpful FROM {reviews} GROUP BY Id),
best AS (
  SELECT * FROM means LEFT SEMI JOIN {sells} AS known ON known.Id = means.Id
  ORDER BY avghelpful DESC, Id LIMIT :k)
SELECT best.Id, p.ASIN, p.title, best.avghelpful
FROM best JOIN {sells} AS p ON p.Id = best.Id
ORDER BY best.avghelpful DESC, best.Id
"""

# (g), variant: the (group, number of comments) pairs that are a group's peak.
TOP_REVIEWERS_TIES = """
WITH active AS (
  SELECT `group`, customer, count(1) AS comments FROM {reviews} GROUP BY ALL)
SELECT `group`, customer, comments FROM active
WHERE (`group`, comments) IN (SELECT `group`, max(comments) FROM active GROUP BY `group`)
"""


def register(sells: DataFrame | None = None, similars: DataFrame | None = None,
             reviews: DataFrame | None = None) -> None:
    """Expose the relations as temp views ``sells``, ``similars``, ``reviews``."""
    for name, df in (("sells", sells), ("similars", similars), ("reviews", reviews)):
        if df is not None:
            df.createOrReplaceTempView(name)


def select_all(spark: SparkSession, sells: DataFrame) -> DataFrame:
    """PRJ-3 + SRC-12: all columns of a named view."""
    register(sells=sells)
    return spark.sql("SELECT * FROM sells")


def better_selling_similars_sql(spark: SparkSession, own: DataFrame, listed: DataFrame, sells: DataFrame) -> DataFrame:
    """Q-B for the product(s) in ``own`` and ``listed``, through SQL text;
    Catalyst makes equi-joins of the comma join."""
    return spark.sql(BETTER_SELLING_SIMILARS, own=own, listed=listed, sells=sells)


def top_sellers_sql(spark: SparkSession, sells: DataFrame, n: int = 10) -> DataFrame:
    """Q-D-SQL through SQL text (rank < n, sentinels kept)."""
    return spark.sql(TOP_SELLERS, args={"n": n}, sells=sells)


def top_reviewers_ties_sql(spark: SparkSession, reviews: DataFrame) -> DataFrame:
    """Q-G-MAX through SQL text."""
    return spark.sql(TOP_REVIEWERS_TIES, reviews=reviews)


def most_helpful_reviews_sql(spark: SparkSession, reviews: DataFrame, k: int = 5) -> DataFrame:
    """Q-A1 through SQL text, for reviews of one product."""
    return spark.sql(MOST_HELPFUL_REVIEWS, args={"k": k}, reviews=reviews)


def daily_rating_sql(spark: SparkSession, reviews: DataFrame) -> DataFrame:
    """Q-C through SQL text, for reviews of one product."""
    return spark.sql(DAILY_RATING, reviews=reviews)


def top_helpful_products_sql(spark: SparkSession, reviews: DataFrame, sells: DataFrame, k: int = 10) -> DataFrame:
    """Q-E through SQL text."""
    return spark.sql(TOP_HELPFUL_PRODUCTS, args={"k": k}, sells=sells, reviews=reviews)
