"""Catalogue text source (SRC-2 .. SRC-11).

The catalogue file is a sequence of records separated by a blank line
(``\\n\\r\\n``); each record is a list of tagged lines::

    Id:   1
    ASIN: P000000001
      title: Part one: the beginning
      group: Book
      salesrank: 10
      similar: 2  P000000002  X1
      categories: 2
       |Books[1]|Subjects[2]
       |Books[1]|Authors[3]
      reviews: total: 2  downloaded: 2  avg rating: 4.5
        2000-7-28  cutomer: C1  rating: 5  votes:  10  helpful:   9

``read_records`` splits the file into records with the text source's
``lineSep`` option (splittable, one row per record) and ``parse_records``
turns each record into a typed struct with built-in expressions only: no
Python per row, no shuffle. Records are independent, so parsing is a narrow
transformation that scales with the number of input splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import strip_ws

# Fixed values of the catalogue text format.
RECORD_SEPARATOR = "\n\r\n"
DISCONTINUED = "discontinued product"
TAGS = ("Id", "ASIN", "title", "group", "salesrank", "similar", "categories")
REVIEW_HEADER_WORDS = ("reviews", "total", "downloaded", "avg")
REVIEW_WORDS = ("cutomer", "rating", "helpful")
DATE_FORMAT = "y-M-d"
_WS = r" \t\n\x0B\f\r"  # what \s matches, for use inside a character class

REVIEW_STRUCT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("customer", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("votes", T.IntegerType()),
    T.StructField("helpful", T.IntegerType()),
])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: one row (``value``) per blank-line-separated record."""
    return spark.read.option("lineSep", RECORD_SEPARATOR).text(path)


# -- line helpers ----------------------------------------------------------------

def _tagged(kv: Column, tag: str) -> Column:
    """Value of the first line whose tag is ``tag`` (NULL when absent).
    ``kv`` is the record's ``array<struct<line, tag, value>>``."""
    hit = F.filter(kv, lambda x: x["tag"] == F.lit(tag))
    return F.try_element_at(hit, F.lit(1))["value"]


def _may_be_tagged(line: Column) -> Column:
    """A stripped line that starts with a tag's name: all lines whose tag it
    is, and a few others."""
    cond = F.lit(False)
    for t in TAGS:
        cond = cond | line.startswith(t)
    return cond


def _has_all(line: Column, words) -> Column:
    cond = F.lit(True)
    for w in words:
        cond = cond & line.contains(w)
    return cond


def _tokens(s: Column) -> Column:
    """FN-8: white-space tokens (no empties)."""
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def _date(tok: Column) -> Column:
    """``try_to_date`` by DATE_FORMAT; the plain form of a date takes the
    cast, which reads it the same and in less time."""
    plain = tok.rlike("^[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}$")
    return F.when(plain, tok.try_cast("date")).otherwise(F.try_to_date(tok, DATE_FORMAT))


def _review(toks: Column) -> Column:
    """A review line's label-free tokens -> struct (date, customer, rating,
    votes, helpful); non-numeric values become NULL."""
    return F.struct(
        _date(F.get(toks, 0)).alias("date"),
        F.get(toks, 1).alias("customer"),
        F.get(toks, 2).try_cast("int").alias("rating"),
        F.get(toks, 3).try_cast("int").alias("votes"),
        F.get(toks, 4).try_cast("int").alias("helpful"),
    )


def _label_free_tokens(line: Column) -> Column:
    """Tokens of a line without the ones holding a colon (the labels).

    One scan of the line: every white-space-free run without a colon, from
    its first to its last character (possessive, so nothing is tried twice).
    The white space is listed: a class that names ``\\s`` within another is
    matched several times slower, and this scan is most of a review's typing.
    """
    return F.regexp_extract_all(line, F.lit(rf"(?<![^{_WS}])[^{_WS}:]++(?![^{_WS}])"), 0)


def _numbers(line: Column) -> Column:
    """Tokens of a line that are digits with an optional dot (FN-10)."""
    return F.filter(_tokens(line), lambda t: t.rlike(r"^[0-9.]+$") & t.rlike("[0-9]"))


def _review_header(lines: Column) -> Column:
    """SRC-9: numbers of the review header line, the first of ``lines``.

    The token array is bound once through a lambda (``transform`` over the
    zero-or-one header lines) instead of being re-evaluated per field.
    """
    hit = F.slice(lines, 1, 1)
    stats = F.transform(F.transform(hit, _numbers), lambda nums: F.struct(
        F.get(nums, 0).try_cast("int").alias("total"),
        F.get(nums, 1).try_cast("int").alias("downloaded"),
        F.get(nums, 2).try_cast("double").alias("avg_rating"),
    ))
    return F.try_element_at(stats, F.lit(1))


def parse_records(records: DataFrame, text_col: str = "value", carry: Sequence[str] = (),
                  keep_discontinued: bool = False) -> DataFrame:
    """SRC-3 + SRC-4: typed product records, header and discontinued
    records dropped (D1: the last line must not be exactly
    ``discontinued product``). ``carry`` names columns of ``records`` to pass
    on; with ``keep_discontinued`` those records stay, with what they hold
    (no reviews), for callers who must hear that a product is gone.

    Output columns: Id, ASIN, title, group, salesrank INT, categories INT,
    similar ARRAY<STRING>, category_paths ARRAY<STRING>,
    review_stats STRUCT<total, downloaded, avg_rating>,
    review_lines ARRAY<STRING> (typed by ``reviews_of`` / ``nested_products``).
    """
    # The first and the last line come from the text itself, and every later
    # step from a column of the one before: an expression that is used twice
    # or pushed below a filter would split the record again.
    body = strip_ws(F.col(text_col))
    first, last = strip_ws(F.substring_index(body, "\n", 1)), strip_ws(F.substring_index(body, "\n", -1))
    keep = (F.locate(":", first) > 0) & (strip_ws(F.substring_index(first, ":", 1)) == F.lit("Id"))
    if not keep_discontinued:
        keep = keep & (last != F.lit(DISCONTINUED))
    lines = F.filter(F.transform(F.split(F.col(text_col), "\n"), strip_ws), lambda l: l != "")
    split = records.filter(keep).select(lines.alias("lines"), *carry)
    ls = F.col("lines")
    found = split.select(
        F.filter(ls, _may_be_tagged).alias("tagged"),
        F.filter(ls, lambda l: l.startswith("|")).alias("paths"),
        F.filter(ls, lambda l: _has_all(l, REVIEW_HEADER_WORDS)).alias("headers"),
        # raw review lines; they are typed row by row after an explode
        # (reviews_of), where the parsing expressions are code-generated
        F.filter(ls, lambda l: _has_all(l, REVIEW_WORDS) & ~_has_all(l, REVIEW_HEADER_WORDS)).alias("review_lines"),
        *carry,
    )
    # The few lines that may carry a tag are split into (tag, value) at their
    # first colon; lines without a colon get a NULL tag.
    kv = F.transform("tagged", lambda l: F.struct(
        F.when(F.locate(":", l) > 0, strip_ws(F.substring_index(l, ":", 1))).alias("tag"),
        strip_ws(F.substr(l, F.locate(":", l) + 1)).alias("value"),
    ))
    parsed = found.select(kv.alias("kv"), "paths", "headers", "review_lines", *carry)
    ls = F.col("kv")
    sim = _tagged(ls, "similar")
    return parsed.select(
        _tagged(ls, "Id").alias("Id"),
        _tagged(ls, "ASIN").alias("ASIN"),
        _tagged(ls, "title").alias("title"),
        _tagged(ls, "group").alias("group"),
        _tagged(ls, "salesrank").try_cast("int").alias("salesrank"),
        _tagged(ls, "categories").try_cast("int").alias("categories"),
        F.coalesce(F.slice(_tokens(F.coalesce(sim, F.lit(""))), 2, 1 << 30),
                   F.array().cast("array<string>")).alias("similar"),
        F.transform("paths", lambda l: F.substr(l, F.lit(2))).alias("category_paths"),
        _review_header(F.col("headers")).alias("review_stats"),
        "review_lines",
        *carry,
    )


# -- relations from parsed records ----------------------------------------------

def sells_of(products: DataFrame) -> DataFrame:
    """SRC-5."""
    return products.select("Id", "ASIN", "title", "group", "salesrank", "categories")


def similars_of(products: DataFrame) -> DataFrame:
    """SRC-6 (explode drops products without similars, as flatMap does)."""
    return products.select("Id", "ASIN", F.explode("similar").alias("similar"))


def categories_of(products: DataFrame) -> DataFrame:
    """SRC-8."""
    return products.select("Id", "ASIN", F.explode("category_paths").alias("category"))


def _exploded(df: DataFrame, keep: Sequence[str], array: str, name: str) -> DataFrame:
    """``explode``, with empty arrays dropped after it: a plain ``explode``
    has the optimizer test the array's size below, which computes a derived
    array once more."""
    rows = df.select(*keep, F.posexplode_outer(array).alias("at", name))
    return rows.filter(F.col("at").isNotNull()).select(*keep, name)


def reviews_of(products: DataFrame) -> DataFrame:
    """SRC-7 (PRJ-4: one row per review): explode the raw review lines, then
    type each line with plain column expressions."""
    lines = _exploded(products, ["Id", "ASIN", "group"], "review_lines", "line")
    r = lines.select("Id", "ASIN", "group", _review(_label_free_tokens(F.col("line"))).alias("r"))
    return r.select("Id", "ASIN", "group", "r.date", "r.customer", "r.rating", "r.votes", "r.helpful")


def reviews_in_file_order(products: DataFrame) -> DataFrame:
    """SRC-7 with each review's position inside its record (``pos``, from
    ``posexplode``): the write order of the reviews of a product, for
    order-dependent operators such as last-write-wins upserts."""
    lines = products.select("Id", "ASIN", "group", F.posexplode("review_lines").alias("pos", "line"))
    r = lines.select("Id", "ASIN", "group", "pos", _review(_label_free_tokens(F.col("line"))).alias("r"))
    return r.select("Id", "ASIN", "group", "pos", "r.date", "r.customer", "r.rating", "r.votes", "r.helpful")


def review_customers(review_lines: Column) -> Column:
    """The customer of each raw review line."""
    return F.transform(review_lines, lambda line: F.get(_label_free_tokens(line), 1))


def review_stats_of(products: DataFrame) -> DataFrame:
    """SRC-9."""
    return products.filter(F.col("review_stats").isNotNull()).select(
        "Id", "review_stats.total", "review_stats.downloaded", "review_stats.avg_rating")


def nested_products(products: DataFrame) -> DataFrame:
    """SRC-10: one nested document per product (Id INT, scalars, an array of
    similar ASINs and an array of review objects). Built from the parsed
    record itself, so no grouping is needed."""
    return products.select(
        F.col("Id").try_cast("int").alias("Id"), "ASIN", "title", "group", "salesrank",
        F.col("similar").alias("similars"),
        F.transform(F.transform("review_lines", _label_free_tokens), lambda toks: F.struct(
            _date(F.get(toks, 0)).alias("date"),
            F.get(toks, 1).alias("customer"),
            F.get(toks, 2).try_cast("int").alias("rating"),
            F.get(toks, 3).try_cast("int").alias("vote"),
            F.get(toks, 4).try_cast("int").alias("helpful"))).alias("reviews"),
    )


def unwind_reviews(docs: DataFrame) -> DataFrame:
    """PRJ-4 (``$unwind``): flatten nested documents to one row per review;
    documents with no reviews vanish."""
    r = _exploded(docs, ["Id", "ASIN"], "reviews", "r")
    return r.select("Id", "ASIN", "r.date", "r.customer", "r.rating", "r.vote", "r.helpful")


# -- packed review strings (SRC-11) ---------------------------------------------

PACK_SEPARATOR = "|"


def pack_reviews(reviews: DataFrame, avg_rating: str | None = None) -> DataFrame:
    """Encode each review as ``date|customer|rating|votes|helpful[|avg]``."""
    parts = [F.date_format("date", "yyyy-MM-dd"), F.col("customer"), F.col("rating").cast("string"),
             F.col("votes").cast("string"), F.col("helpful").cast("string")]
    if avg_rating:
        parts.append(F.col(avg_rating).cast("string"))
    # concat_ws skips NULLs, which would shift later fields: pack NULL as ''.
    parts = [F.coalesce(p, F.lit("")) for p in parts]
    return reviews.select("Id", "ASIN", F.concat_ws(PACK_SEPARATOR, *parts).alias("packed"))


def unpack_reviews(packed: DataFrame) -> DataFrame:
    """Decode packed review strings; non-numeric fields become NULL."""
    p = F.split(F.col("packed"), r"\|")
    return packed.select(
        "Id", "ASIN",
        F.try_to_date(F.get(p, 0), "yyyy-MM-dd").alias("date"),
        F.nullif(F.get(p, 1), F.lit("")).alias("customer"),
        F.get(p, 2).try_cast("int").alias("rating"),
        F.get(p, 3).try_cast("int").alias("votes"),
        F.get(p, 4).try_cast("int").alias("helpful"),
    )
