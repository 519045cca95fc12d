"""Generic aggregates (AGG-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def numeric_means(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-5: mean of every numeric non-key column per key (``avg_<col>``),
    the named form of ``groupBy(keys).avg()``."""
    keys = list(keys)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])
