"""Catalogue file round trips: render the fixture relations as catalogue
text / CSV / query tables with Spark, read them back, and answer from the
files. The files live in a fresh folder under the session's checkpoint dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import questions as Q
from tessera.plans.wordcount import wordcount
from tessera.session import scratch_dir
from tessera.sinks import catalog_text, versions
from tessera.sinks.catalog_text import write_catalog_text
from tessera.sinks.files import read_csv, read_term_counts, write_csv, write_part_files, write_term_counts
from tessera.operators.lookup import lookup, lookup_join
from tessera.operators.topk import top_n_per_group
from tessera.operators.wordcount import word_count
from tessera.sinks.reports import read_report, write_report
from tessera.sinks.query_tables import read_query_table, write_query_table, write_question_table
from tessera.sources import catalog as C
from tessera.sources import records as R
from tessera.sources.base import derived, parsed_base
from tessera.sources.text import read_lines, write_corpus


def write_fixture_catalog(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The tables rendered as catalogue text, packed: its lines repeat most
    of their words, and are the most that these round trips write."""
    write_catalog_text(spark, C.sells(spark, sf_dir), C.similars(spark, sf_dir), C.categories(spark, sf_dir),
                       C.reviews(spark, sf_dir, with_group=False), path, discontinued=discontinued_products(spark, sf_dir),
                       compression="lz4")


def fixture_catalog(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue text of the tables as they are now, rendered once."""
    tables = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("part", "lineitem", "orders")]
    return derived(spark, "catalogue", tables, [C, catalog_text, write_fixture_catalog, discontinued_products],
                   lambda folder: write_fixture_catalog(spark, sf_dir, folder))


def discontinued_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Id, ASIN) of records that a catalogue lists as discontinued: one for
    every twentieth product, under an Id that no product has."""
    own = C.sells(spark, sf_dir).filter(F.col("Id").cast("long") % 20 == 0)
    return own.select(F.concat(F.lit("9"), F.lpad("Id", 12, "0")).alias("Id"), F.concat(F.lit("D"), "ASIN").alias("ASIN"))


def parsed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed catalogue (one row per product record). The text and the
    parsed base table are shared files named by what they are made from
    (SRC-13): the first query after a change renders and parses, the others
    read."""
    return parsed_base(spark, fixture_catalog(spark, sf_dir))


def parsed_once(spark, sf_dir):
    """SRC-13: two questions from one base table: per product the numbers of
    reviews and of similar products."""
    products = parsed_products(spark, sf_dir)
    reviews = R.reviews_of(products).groupBy("Id").agg(F.count(F.lit(1)).alias("n_reviews"))
    similars = R.similars_of(parsed_products(spark, sf_dir)).groupBy("Id").agg(F.count(F.lit(1)).alias("n_similars"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (R.sells_of(products).select("Id").join(reviews, "Id", "left").join(similars, "Id", "left")
            .select("Id", zero("n_reviews"), zero("n_similars")))


def roundtrip_sells(spark, sf_dir):
    return R.sells_of(parsed_products(spark, sf_dir))


def roundtrip_similars(spark, sf_dir):
    return R.similars_of(parsed_products(spark, sf_dir))


def roundtrip_reviews(spark, sf_dir):
    return R.reviews_of(parsed_products(spark, sf_dir))


def roundtrip_categories(spark, sf_dir):
    return R.categories_of(parsed_products(spark, sf_dir))


def roundtrip_stats(spark, sf_dir):
    return R.review_stats_of(parsed_products(spark, sf_dir))


def nested_products_flattened(spark, sf_dir):
    """SRC-10 + PRJ-4: nested documents from the parsed file, unwound."""
    return R.unwind_reviews(R.nested_products(parsed_products(spark, sf_dir)))


def packed_reviews_roundtrip(spark, sf_dir):
    """SRC-11: pack every review into one delimited string and decode it."""
    return R.unpack_reviews(R.pack_reviews(C.reviews(spark, sf_dir, with_group=False)))


SELLS_SCHEMA = T.StructType([
    T.StructField("Id", T.StringType()), T.StructField("ASIN", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("group", T.StringType()),
    T.StructField("salesrank", T.IntegerType()), T.StructField("categories", T.IntegerType()),
])


def csv_roundtrip(spark, sf_dir):
    """SNK-3: sells to a CSV directory (fails if it exists) and back, with
    an explicit schema."""
    path = scratch_dir(spark, "csv")
    write_csv(C.sells(spark, sf_dir), path)
    return read_csv(spark, path, SELLS_SCHEMA)


def csv_single_file_top_sellers(spark, sf_dir):
    """SNK-4: the Q-D-EXACT answer (n rows per group, however many tie) as
    one CSV file, read back."""
    path = scratch_dir(spark, "csv1")
    write_csv(Q.top_sellers_exact(C.sells(spark, sf_dir)), path, single_file=True,
              order=["group", "salesrank", "Id"])
    schema = T.StructType([T.StructField("group", T.StringType()), T.StructField("Id", T.StringType()),
                           T.StructField("title", T.StringType()), T.StructField("salesrank", T.IntegerType())])
    return read_csv(spark, path, schema)


def query_table_roundtrip(spark, sf_dir, product_id: str = "6"):
    """SNK-5: the reviews query table clustered by product (helpful desc,
    rating desc inside), then Q-A1 answered from it. The product filter
    reaches the parquet scan and skips row groups by their Id range."""
    path = scratch_dir(spark, "qt")
    write_query_table(C.reviews(spark, sf_dir), path, cluster_by=["Id"],
                      order=[F.col("helpful").desc(), F.col("rating").desc()])
    return Q.most_helpful_reviews(read_query_table(spark, path), product_id, rating_desc=True)


def daily_partials_table(spark, sf_dir, product_id: str = "6"):
    """AGG-12 stored: per (Id, date) sum and count written clustered by Id,
    finalised to daily means of one product at read time."""
    path = scratch_dir(spark, "qt")
    partials = Q.daily_partials(C.reviews(spark, sf_dir, with_group=False, with_customer=False))
    write_query_table(partials, path, cluster_by=["Id"], order=[F.col("date").asc()])
    t = read_query_table(spark, path).filter(F.col("Id") == F.lit(product_id))
    return Q.daily_rating_from_partials(t).select("date", "avgrating")


def _question_table(spark, sf_dir, name: str, with_reviews: bool = True) -> DataFrame:
    path = scratch_dir(spark, f"qt-{name}")
    reviews = C.reviews(spark, sf_dir) if with_reviews else None
    write_question_table(name, path, C.sells(spark, sf_dir), C.similars(spark, sf_dir), reviews)
    return read_query_table(spark, path)


def top_sellers_from_query_table(spark, sf_dir, n: int = 10):
    """Q-D-EXACT from the ``groups`` table (partitioned by group, clustered by
    rank): exactly n products per group, ties by Id."""
    t = _question_table(spark, sf_dir, "groups", with_reviews=False)
    return top_n_per_group(t, ["group"], [F.col("salesrank").asc(), F.col("Id").asc()], n) \
        .select("group", "Id", "ASIN", "salesrank")


def top_reviewers_from_query_table(spark, sf_dir, n: int = 10):
    """Q-G from the ``customer_reviews`` table (partitioned by group; total
    descending, customer ascending inside)."""
    t = _question_table(spark, sf_dir, "customer_reviews")
    return top_n_per_group(t, ["group"], [F.col("total").desc(), F.col("customer").asc()], n) \
        .select("group", "customer", F.col("total").alias("comments"))


def question_table(name: str):
    """SNK-5: one of the six question tables, written and read back whole."""
    return lambda spark, sf_dir: _question_table(spark, sf_dir, name)


def output_replaced(spark, sf_dir):
    """SNK-2: the counts of all terms, then of alphabetic terms, written to
    one folder; what is read is the second."""
    path = scratch_dir(spark, "replaced")
    for alpha in (False, True):
        write_term_counts(wordcount(spark, sf_dir, alpha_only=alpha), path)
    return read_term_counts(spark, path)


def output_published(spark, sf_dir):
    """SNK-2 as one step for readers: the counts of all terms are published,
    then those of alphabetic terms; what is current is the second."""
    path = scratch_dir(spark, "published")
    for alpha in (False, True):
        versions.replace(spark, path, lambda folder, alpha=alpha: write_part_files(wordcount(spark, sf_dir, alpha_only=alpha), folder))
    return read_term_counts(spark, versions.current(spark, path))


def similars_looked_up(spark, sf_dir):
    """JN-7 / FLT-9: every similar product's rank, looked up by ASIN in the
    ``products`` table, which is clustered by Id; one outside the catalogue
    gives no row."""
    products = _question_table(spark, sf_dir, "products", with_reviews=False).select("ASIN", "salesrank")
    asked = C.similars(spark, sf_dir).select("Id", "similar")
    return lookup_join(products, "ASIN", asked, "similar").select("Id", "similar", F.col("salesrank").alias("similar_salesrank"))


def products_by_asin(spark, sf_dir, product_id: str):
    """JN-7: the products that a product lists, found by their ASINs with a
    filter that Bloom filters answer; those outside the catalogue are none."""
    listed = [r.similar for r in C.similars(spark, sf_dir, product_id).select("similar").collect()]  # a record's few
    return lookup(_question_table(spark, sf_dir, "products", with_reviews=False), "ASIN", listed)


def terms_sorted_in_files(spark, sf_dir):
    """SRT-7: neighbours in a part file that are out of byte order: none."""
    path = scratch_dir(spark, "sorted")
    write_term_counts(wordcount(spark, sf_dir), path)
    lines = spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("term"), F.input_file_name().alias("file"),
                                         F.monotonically_increasing_id().alias("line"))
    before = F.lag("term").over(Window.partitionBy("file").orderBy("line"))
    return lines.select(F.col("term"), (before > F.col("term")).alias("late")).agg(
        F.count(F.lit(1)).alias("terms"), F.coalesce(F.sum(F.col("late").cast("long")), F.lit(0).cast("long")).alias("out_of_order"))


def best_sellers_report(spark, sf_dir):
    """SRT-10: Q-D as a report, in (group, salesrank, Id) order, with each
    line's position over the whole report as its files hold it."""
    path = scratch_dir(spark, "report")
    write_report(Q.top_sellers_rank(C.sells(spark, sf_dir)), path, ["group", "salesrank", "Id"])
    return (read_report(spark, path, "`group` string, Id string, title string, salesrank int")
            .select("group", "Id", "salesrank", "position"))


def daily_rating_report(spark, sf_dir):
    """SRT-5: the daily means over all products as a report in date order,
    with each line's position over the whole report."""
    path = scratch_dir(spark, "daily")
    write_report(Q.daily_rating_all(C.reviews(spark, sf_dir, with_group=False, with_customer=False)), path, ["date"])
    return read_report(spark, path, "date date, avgrating double")


def better_similars_from_query_table(spark, sf_dir):
    """Q-B for every product from the ``similars`` table, whose rows already
    carry both ranks (-1 for a similar product outside the catalogue)."""
    t = _question_table(spark, sf_dir, "similars", with_reviews=False)
    return (t.filter((F.col("similarsales") > 0) & (F.col("similarsales") < F.col("salesrank")))
             .select("Id", "similar", F.col("salesrank").alias("salesrank_original"),
                     F.col("similarsales").alias("salesrank")))


def wordcount_text_files(spark, sf_dir):
    """Q-WC as the reference job runs it: over plain text files (SRC-1)."""
    path = scratch_dir(spark, "corpus")
    write_corpus(spark, sf_dir, path)
    return word_count(read_lines(spark, path), "value")


def reviews_upserted(spark, sf_dir):
    """SNK-7 on parsed text: the review table keyed by (Id, helpful, rating)
    where a later review line of a product overwrites an earlier one with
    the same key (last write wins, by position in the record).

    The records are dealt out by product before they are unwound: a record's
    lines stay together in the shuffle, where they pack well, and the one sort
    for the key is over a shuffle partition, not also over a whole file split.
    """
    from tessera.operators.upsert import latest_by_key
    r = R.reviews_in_file_order(parsed_products(spark, sf_dir).repartition("Id"))
    latest = latest_by_key(r.select("Id", "helpful", "rating", "pos", "ASIN", "date", "customer", "votes"),
                           ["Id", "helpful", "rating"], "pos")
    return latest.select("Id", "ASIN", "date", "customer", "rating", F.col("votes").alias("vote"), "helpful")
