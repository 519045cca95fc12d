"""Catalogue text parser on hand-written edge records."""

import datetime as dt

import pytest

from tessera.sources import records as R

RECORDS = [
    ["# header comment", "Total items: 5"],
    ["Id:   0", "ASIN: A000", "  discontinued product"],
    ["Id:   1", "ASIN: A001", "  title: Part one: the beginning", "  group: Book", "  salesrank: 10",
     "  similar: 2  A002  A999", "  categories: 2", "   |Books[1]|Subjects[2]", "   |Books[1]|Authors[3]",
     "  reviews: total: 3  downloaded: 3  avg rating: 4.5",
     "    2000-7-28  cutomer: C1  rating: 5  votes:  10  helpful:   9",
     "    2003-12-14  cutomer: C2  rating: 4  votes:   6  helpful:   5",
     "    2003-12-14  cutomer: C2  rating: 4  votes:   6  helpful:   5"],
    ["Id:   2", "ASIN: A002", "  title: No reviews", "  group: DVD", "  salesrank: -1", "  similar: 0",
     "  categories: 0", "  reviews: total: 0  downloaded: 0  avg rating: 0"],
    ["Id:   3", "ASIN: A003", "  title: The discontinued product", "  group: Book", "  salesrank: 0",
     "  similar: 1  A001", "  categories: 1", "   |Books[1]",
     "  reviews: total: 1  downloaded: 1  avg rating: 3",
     "    2001-1-5  cutomer: C9  rating: x  votes:  2  helpful:   1"],
]


@pytest.fixture(scope="module")
def products(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalogue.txt"
    text = "\n\r\n".join("\r\n".join(lines) for lines in RECORDS) + "\r\n"
    path.write_bytes(text.encode("utf-8"))
    return R.parse_records(R.read_records(spark, str(path))).cache()


def test_header_and_discontinued_dropped(products):
    assert sorted(r.Id for r in products.select("Id").collect()) == ["1", "2", "3"]


def test_title_keeps_text_after_first_colon(products):
    row = products.filter("Id = '1'").first()
    assert row.title == "Part one: the beginning"
    assert row.group == "Book" and row.salesrank == 10 and row.categories == 2


def test_title_with_discontinued_words_is_kept(products):
    assert products.filter("Id = '3'").first().title == "The discontinued product"


def test_similars_drop_the_count(products):
    sims = {(r.Id, r.similar) for r in R.similars_of(products).collect()}
    assert sims == {("1", "A002"), ("1", "A999"), ("3", "A001")}


def test_categories(products):
    cats = sorted((r.Id, r.category) for r in R.categories_of(products).collect())
    assert cats == [("1", "Books[1]|Authors[3]"), ("1", "Books[1]|Subjects[2]"), ("3", "Books[1]")]


def test_reviews_types_unpadded_dates_and_ties(products):
    rows = sorted(R.reviews_of(products).collect(), key=lambda r: (r.Id, r.date, r.customer))
    assert len(rows) == 4  # tied duplicate review kept
    first = rows[0]
    assert (first.Id, first.group, first.date, first.customer, first.rating, first.votes, first.helpful) == \
        ("1", "Book", dt.date(2000, 7, 28), "C1", 5, 10, 9)
    bad = [r for r in rows if r.Id == "3"][0]
    assert bad.rating is None and bad.votes == 2 and bad.helpful == 1


def test_review_stats(products):
    stats = {r.Id: (r.total, r.downloaded, r.avg_rating) for r in R.review_stats_of(products).collect()}
    assert stats == {"1": (3, 3, 4.5), "2": (0, 0, 0.0), "3": (1, 1, 3.0)}


def test_nested_documents_and_unwind(products):
    docs = R.nested_products(products)
    assert docs.schema["Id"].dataType.simpleString() == "int"
    flat = R.unwind_reviews(docs)
    assert flat.count() == 4
    assert set(flat.columns) == {"Id", "ASIN", "date", "customer", "rating", "vote", "helpful"}
    # a document without reviews vanishes when unwound
    assert flat.filter("Id = 2").count() == 0


def test_packed_reviews_round_trip(products):
    revs = R.reviews_of(products)
    back = R.unpack_reviews(R.pack_reviews(revs))
    cols = ["Id", "ASIN", "date", "customer", "rating", "votes", "helpful"]
    assert sorted(map(tuple, back.select(cols).collect()), key=str) == \
        sorted(map(tuple, revs.select(cols).collect()), key=str)


def test_many_splits_give_same_records(spark, tmp_path):
    """Records stay whole when the file is read in many small splits."""
    path = tmp_path / "big.txt"
    recs = ["\r\n".join([f"Id:   {i}", f"ASIN: A{i:04d}", f"  title: t{i}", "  group: G",
                         f"  salesrank: {i}", "  similar: 0", "  categories: 0",
                         "  reviews: total: 0  downloaded: 0  avg rating: 0"]) for i in range(3000)]
    path.write_bytes(("\n\r\n".join(recs) + "\r\n").encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = R.read_records(spark, str(path))
        assert df.rdd.getNumPartitions() > 10
        got = R.parse_records(df)
        assert got.count() == 3000
        assert got.agg({"salesrank": "sum"}).first()[0] == sum(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_review_schema_is_declared(products):
    got = R.reviews_of(products).select("date", "customer", "rating", "votes", "helpful").schema
    assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in R.REVIEW_STRUCT.fields]


def test_tokens_of_odd_lines(spark):
    rows = [("  2000-7-28  cutomer: C1  rating: 5", ["2000-7-28", "C1", "5"]), ("a:b c:d", []), ("x:  :y z", ["z"]), ("a\tb:c \x0bd", ["a", "d"])]
    df = spark.createDataFrame([(line,) for line, _ in rows], "line string")
    assert [r.t for r in df.select(R._label_free_tokens(df.line).alias("t")).collect()] == [t for _, t in rows]


def test_tokens_are_scanned_with_listed_white_space(spark):
    from pyspark.sql import functions as F
    space = " \t\n\x0b\f\r"
    lines = [f"a{c}b:{c}{c}c" for c in space] + ["a\u00a0b c", "a\u2003b:c d", "a\x1cb", ":", "", space, "a", None]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    tokens = R._label_free_tokens(F.col("line"))
    got = df.select("line", tokens.alias("t"), F.filter(F.split("line", r"\s+"), lambda t: (t != "") & ~t.contains(":")).alias("want")).collect()
    assert [r.t for r in got] == [r.want for r in got] and got[0].t == ["a", "c"]
    pattern = df.select(tokens.alias("t"))._jdf.queryExecution().analyzed().toString()
    assert "\\s" not in pattern and "\\S" not in pattern  # named within a class it is matched several times slower


def test_plain_dates_are_read_as_the_format_reads_them(spark):
    from pyspark.sql import functions as F
    texts = ["2000-7-28", "2000-02-30", "2001-2-29", "0000-1-1", "2000", "2000-7", "2000-7-28T", "12000-1-1", "999-1-1", "", None, "2000-13-1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.a for r in df.select(R._date(df.t).cast("string").alias("a")).collect()] == \
        [r.a for r in df.select(F.try_to_date(df.t, R.DATE_FORMAT).cast("string").alias("a")).collect()]


def test_dates_are_written_as_the_format_writes_them(spark):
    from pyspark.sql import functions as F
    from tessera.sinks.catalog_text import _dates
    days = spark.sql("select date_add(date'0001-01-01', cast(id * 97 as int)) as d from range(40000) union all "
                     "select explode(array(null, make_date(12000, 1, 2), make_date(0, 3, 4), make_date(-5, 3, 4)))")
    iso, written = _dates(F.col("d"))
    other = ~iso.eqNullSafe(F.date_format("d", "yyyy-MM-dd")) | ~written.eqNullSafe(F.date_format("d", R.DATE_FORMAT))
    assert days.filter(other).count() == 0 and days.filter(F.year("d") > 9999).count() > 0


def test_nested_reviews_are_built_once(products):
    plan = R.unwind_reviews(R.nested_products(products))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("regexp_extract_all") == 1


def test_stray_reviews_take_no_product_with_them(spark, tmp_path):
    from pyspark.sql import functions as F
    from tessera.sinks.catalog_text import write_catalog_text
    sells = spark.createDataFrame([(str(i), f"A{i}", f"t{i}", "Book", i, 0) for i in range(1, 4)],
                                  "Id string, ASIN string, title string, `group` string, salesrank int, categories int")
    day = dt.date(2000, 1, 2)
    reviews = spark.createDataFrame([(i, day, c, 4, 1, 1) for i, c in [(None, "x"), (None, None), ("2", "y"), ("0", "z"), ("3", None), ("3", "y")]],
                                    "Id string, date date, customer string, rating int, votes int, helpful int")
    none = sells.select("Id", "ASIN", F.lit("").alias("similar"), F.lit("").alias("category")).filter("false")
    write_catalog_text(spark, sells, none.drop("category"), none.drop("similar"), reviews, str(tmp_path / "c"), partitions=1)
    products = R.parse_records(R.read_records(spark, str(tmp_path / "c")))
    assert sorted((r.Id, r.review_stats.total, len(r.review_lines)) for r in products.collect()) == [("1", 0, 0), ("2", 1, 1), ("3", 2, 1)]
