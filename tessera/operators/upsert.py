"""Last-write-wins upsert on a key (SNK-7).

A keyed store that overwrites on insert keeps, per key, the row written
last. As a Spark plan that is ``max_by(row, sequence)`` per key: a hash
aggregate with a map-side partial step, so a key holding a third of all rows
is reduced inside every map task before the shuffle (a ``row_number``
window would instead pull the whole key into one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Per ``key`` the row with the largest ``seq`` (unique per key)."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(seq)).alias("__row")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest])


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Apply ``updates`` on top of ``base``: union, then last write wins.
    Both sides carry the sequence column (the update's is larger)."""
    return latest_by_key(base.unionByName(updates), key, seq)
