"""Look-ups by a key that a table is not clustered by (JN-7, FLT-9).

A few keys: ``lookup`` filters on the key column, which reaches the Parquet
scan; row groups whose Bloom filter (written for the column by the query
table) holds none of the keys are not read.

Many keys: ``lookup_join`` first keeps only the rows whose key falls into a
slot that some asked key falls into, a broadcast of at most ``SLOTS`` numbers
whatever is asked, and joins the rest exactly. So the big table's rows that
nobody asks for stay out of the shuffle. With more asked keys than slots
nearly every row passes and the plain join remains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def lookup(table: DataFrame, column: str, keys: Sequence) -> DataFrame:
    """Rows of ``table`` with one of ``keys`` in ``column`` (a missing key
    gives no row, null is never found). A filter for each key, as Parquet
    compares a short list with its Bloom filters and a long one only with
    minimum and maximum."""
    found = F.lit(False)
    for key in keys:
        if key is not None:
            found = found | (F.col(column) == F.lit(key))
    return table.filter(found)


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def lookup_join(table: DataFrame, column: str, asked: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``asked`` joined with the rows of ``table`` whose ``column`` equals its
    ``key``; a key that isn't there gives no row (``inner``) or one of nulls
    (``left``). Columns of ``asked``, then those of ``table`` but ``column``;
    both key columns must have one type."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    if table.schema[column].dataType != asked.schema[key].dataType:
        raise ValueError("the key columns differ in type")  # their slots would differ
    slots = F.broadcast(asked.filter(F.col(key).isNotNull()).select(_slot(F.col(key)).alias("slot_asked")).distinct())
    near = table.join(slots, _slot(table[column]) == slots["slot_asked"], "left_semi")
    rest = [c for c in table.columns if c != column]
    near = near.select(F.col(column).alias("key_found"), *rest)
    return asked.join(near, asked[key] == near["key_found"], how).select(*[asked[c] for c in asked.columns], *[near[c] for c in rest])
