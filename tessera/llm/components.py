"""Connected components of a link table by alternating large and small stars.

Links never leave Spark: every round is a few joins and aggregates on the
link table, written to the shared scratch folder to cut the lineage; the
driver only sees the number and checksum of links. A node with very many
links is a hot key of a plain equi-join whose sides are both shuffled for it,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of ``links`` (a, b)
    reaches. Null ends and self links are ignored; repeated links count once."""
    ends = F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    now = staged(links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(*ends).distinct(), "links")
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "least")
        large = both.join(least, both.a == least.u).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a != b").distinct(), "large-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"), "least")
        small = large.join(least, large.a == least.u)
        now = staged(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "small-star")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    star = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return star.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
