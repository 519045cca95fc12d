"""Word-count operators (AGG-1, AGG-2, AGG-11, SNK-6, SRT-8).

The plan is scan -> tokenise -> explode -> partial HashAggregate ->
Exchange(hash term) -> final HashAggregate. The partial aggregate is the
map-side combiner: a term that makes up a third of all tokens still reaches
its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import DEFAULT_REDUCERS, hash_bucket, is_alpha_word, tokenize
from tessera.operators.topk import top_n_per_group


def terms(df: DataFrame, text_col: str = "text", alpha_only: bool = False) -> DataFrame:
    """One row per token occurrence: ``term``."""
    out = df.select(F.explode(tokenize(text_col)).alias("term"))
    if alpha_only:
        out = out.filter(is_alpha_word("term"))
    return out


def word_count(df: DataFrame, text_col: str = "text", alpha_only: bool = False) -> DataFrame:
    """AGG-1 / AGG-2: ``(term STRING, count BIGINT)``."""
    return terms(df, text_col, alpha_only).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """AGG-11: number of unique terms and total tokens of a word count."""
    return counts.agg(
        F.count(F.lit(1)).alias("unique_terms"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("tokens"),
    )


def with_bucket(counts: DataFrame, n: int = DEFAULT_REDUCERS, key: str = "term") -> DataFrame:
    """SNK-6: add the deterministic output part of each key as ``bucket``."""
    return counts.withColumn("bucket", hash_bucket(key, n))


def bucket_edges(bucketed: DataFrame, first_k: int = 1, last_k: int = 3,
                 key: str = "term") -> DataFrame:
    """SRT-8: per bucket, the ``first_k``-th key in byte order and the
    ``last_k``-th key from the end (first and third-from-last by default).

    Each side is a per-bucket top-n (WindowGroupLimit), so a bucket of any
    size only ships ``k`` rows per map task to its window.
    """
    first = (top_n_per_group(bucketed, ["bucket"], [F.col(key).asc()], first_k, rank_col="pos")
             .filter(F.col("pos") == first_k)
             .withColumn("position", F.lit("first")))
    last = (top_n_per_group(bucketed, ["bucket"], [F.col(key).desc()], last_k, rank_col="pos")
            .filter(F.col("pos") == last_k)
            .withColumn("position", F.lit("from_last")))
    cols = ["bucket", "position", "pos", key, "count"]
    return first.select(*cols).unionByName(last.select(*cols))
