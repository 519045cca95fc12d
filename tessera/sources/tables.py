"""Parquet table access for the driver-provided test tables.

Only ``spark.read.parquet`` is used, so Catalyst prunes columns and pushes
filters into the scan; callers select the columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_query_settings

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Natural key of each driver table.
KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
    "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
    "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
    "labels": "doc_id", "conversations": "conv_id",
}


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """Read one table; ``sf_dir`` holds ``<name>.parquet``. The scan's own
    splits are kept; ``partitions`` deals the rows out by the table's key,
    for callers who know that a file has too few row groups."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    ensure_query_settings(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions, KEYS[name]) if partitions else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Named temp views over the parquet tables (SRC-12)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
