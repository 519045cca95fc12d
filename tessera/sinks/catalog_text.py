"""Write catalogue relations as a catalogue text file (inverse of
``sources.records``).

The file is produced line by line. Every review is dealt out by its product
once, as the typed fields it has; the lines before and after a product's
reviews are rows of the same shuffle. In each task the rows of a product are
sorted into file order, its review totals are a window over them (so the
reviews are computed, shuffled and sorted once, not once more for the header),
and only then is a row turned into its line. No record string is ever
assembled in memory, so a product with a huge number of reviews is streamed
(and spilled) like any sorted partition. Each output file holds whole records,
so any split of it parses independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.records import DATE_FORMAT, DISCONTINUED

CR = "\r"  # every line ends in \r\n; records are followed by a blank line


HEAD, CATEGORY, TOTALS, REVIEW, END = 0, 7, 8, 9, 10  # sections of a record, in file order
_FIELDS = ("date", "customer", "rating", "votes", "helpful")


def _rows(df: DataFrame, sec: Column, text: Column, seq: Column, fields: dict[str, Column]) -> DataFrame:
    """(key, sec, text, seq, review fields). ``text`` is a line's text, null
    for the lines made after the shuffle and for those that are null."""
    return df.select(F.col("Id").alias("key"), sec.alias("sec"), text.alias("text"), seq.alias("seq"),
                     *[c.alias(name) for name, c in fields.items()])


def _entries(*lines: tuple[int, Column]) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(sec).alias("sec"), text.cast("string").alias("text")) for sec, text in lines]))


def catalog_rows(spark: SparkSession, sells: DataFrame, similars: DataFrame, categories: DataFrame,
                 reviews: DataFrame, header: bool = True, discontinued: DataFrame | None = None) -> DataFrame:
    """All rows of the catalogue file, see ``_rows``; ``catalog_lines`` makes
    lines of them.

    A product's ``similar:`` line is one list: the format's own limit, which
    holds for catalogues whose products list a few similar ones each.
    ``discontinued`` (Id, ASIN) adds records without data that end in the
    words of the format.
    """
    sims = (similars.groupBy("Id")
            .agg(F.count(F.lit(1)).alias("n"), F.concat_ws("  ", F.sort_array(F.collect_list("similar"))).alias("l")))
    cats = categories.select("Id", "category").distinct()
    ncat = cats.groupBy("Id").agg(F.count(F.lit(1)).alias("ncat"))
    p = (sells.join(sims, "Id", "left").join(ncat, "Id", "left")
         .select("Id", "ASIN", "title", "group", "salesrank", F.coalesce("n", F.lit(0)).alias("n"), F.col("l"),
                 F.coalesce("ncat", F.lit(0)).alias("ncat")))
    sim_line = F.when(F.col("n") > 0, F.concat(F.lit("  similar: "), F.col("n").cast("string"), F.lit("  "), F.col("l"))) \
        .otherwise(F.lit("  similar: 0"))
    product_lines = [
        F.concat(F.lit("Id:   "), F.col("Id")),
        F.concat(F.lit("ASIN: "), F.col("ASIN")),
        F.concat(F.lit("  title: "), F.col("title")),
        F.concat(F.lit("  group: "), F.col("group")),
        F.concat(F.lit("  salesrank: "), F.col("salesrank").cast("string")),
        sim_line,
        F.concat(F.lit("  categories: "), F.col("ncat").cast("string")),
    ]
    none, types = F.lit(""), dict(reviews.dtypes)
    no_review = {c: F.lit(None).cast(types[c]) for c in _FIELDS}
    head = p.select("Id", _entries(*[(HEAD + i, F.concat(x, F.lit(CR))) for i, x in enumerate(product_lines)],
                                   (TOTALS, F.lit(None)), (END, F.lit(CR))))
    parts = [
        _rows(head, F.col("sec"), F.col("text"), none, no_review),
        _rows(cats, F.lit(CATEGORY), F.concat(F.lit("   |"), F.col("category"), F.lit(CR)), F.col("category"), no_review),
        _rows(reviews, F.lit(REVIEW), F.lit(None).cast("string"), none, {c: F.col(c) for c in _FIELDS}),
    ]
    if discontinued is not None:
        gone = discontinued.select("Id", _entries(*enumerate([F.concat(x, F.lit(CR)) for x in (
            F.concat(F.lit("Id:   "), F.col("Id")), F.concat(F.lit("ASIN: "), F.col("ASIN")), F.lit("  " + DISCONTINUED), F.lit(""))])))
        parts.append(_rows(gone, F.col("sec"), F.col("text"), none, no_review))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if header:
        total = sells.agg(F.count(F.lit(1)).alias("n")).withColumn("Id", F.lit(None).cast("string"))
        head = F.concat(F.lit("# Full information about products" + CR + "\n" + "Total items: "),
                        F.col("n").cast("string"), F.lit(CR + "\n" + CR))
        out = _rows(total, F.lit(HEAD), head, none, no_review).unionByName(out)
    return out


def _dates(date: Column) -> tuple[Column, Column]:
    """A date as ``yyyy-MM-dd`` and by DATE_FORMAT. Years of at most four
    digits are written from their parts, which reads the same and takes a
    fraction of a formatter's time."""
    day = date.cast("date")
    plain = F.year(day).between(1, 9999)
    parts = F.concat(F.year(day).cast("string"), F.lit("-"), F.month(day).cast("string"), F.lit("-"), F.dayofmonth(day).cast("string"))
    return (F.when(plain, day.cast("string")).otherwise(F.date_format(date, "yyyy-MM-dd")),
            F.when(plain, parts).otherwise(F.date_format(date, DATE_FORMAT)))


def catalog_lines(rows: DataFrame) -> DataFrame:
    """Rows in file order within each partition, which holds all rows of its
    products, as lines (``value``)."""
    review = F.col("sec") == REVIEW
    iso, written = _dates(F.col("date"))
    seq = F.when(review, F.concat_ws("|", iso, F.col("customer"),
                                     F.lpad(F.col("rating").cast("string"), 3, "0"),
                                     F.lpad(F.col("votes").cast("string"), 10, "0"),
                                     F.lpad(F.col("helpful").cast("string"), 10, "0"))).otherwise(F.col("seq"))
    # Numeric keys sort numerically and the header (NULL key) comes first. The
    # window has the same order, so there is one sort.
    keyed = rows.withColumns({"knum": F.col("key").try_cast("long"), "seq": seq, "of_review": F.when(review, F.col("rating"))})
    ordered = Window.partitionBy("knum", "key").orderBy("sec", "seq")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(review.cast("int")).over(whole)
    counted = keyed.withColumns({"total": total, "avg": F.avg("of_review").over(whole), "next": F.lead("sec").over(ordered)})
    n = F.col("total").cast("string")
    totals = F.concat(F.lit("  reviews: total: "), n, F.lit("  downloaded: "), n, F.lit("  avg rating: "),
                      F.coalesce(F.round("avg", 1).cast("string"), F.lit("0")), F.lit(CR))
    line = F.concat(F.lit("    "), written,
                    F.lit("  cutomer: "), F.col("customer"),
                    F.lit("  rating: "), F.col("rating").cast("string"),
                    F.lit("  votes: "), F.col("votes").cast("string"),
                    F.lit("  helpful: "), F.col("helpful").cast("string"), F.lit(CR))
    value = F.when(review, line).when(F.col("sec") == TOTALS, totals).otherwise(F.col("text"))
    # lines whose product isn't listed have no record; they are closed as one, or the next record would be lost to them
    stray = F.col("next").isNull() & F.col("sec").isin(CATEGORY, REVIEW)
    return counted.select(F.when(stray, F.concat(F.coalesce(value, F.lit("")), F.lit("\n" + CR))).otherwise(value).alias("value"))


def write_catalog_text(spark: SparkSession, sells: DataFrame, similars: DataFrame, categories: DataFrame,
                       reviews: DataFrame, path: str, partitions: int | None = None,
                       discontinued: DataFrame | None = None, compression: str = "none") -> None:
    """Write the catalogue file(s) under ``path`` (replacing old output). A
    record is written by one task, as the format needs its lines together.
    With ``compression`` a file is also read by one task, as it was written."""
    rows = catalog_rows(spark, sells, similars, categories, reviews, discontinued=discontinued)
    # A record only needs its own lines to be contiguous, so a hash shuffle
    # on the product key is enough (a range shuffle would first run the whole
    # plan once more to sample boundaries).
    dealt = rows.repartition(*([partitions] if partitions else []), "key")
    catalog_lines(dealt).write.mode("overwrite").text(path, compression=compression)
