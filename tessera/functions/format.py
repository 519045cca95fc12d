"""Report formats (FN-14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_decimals(x) -> Column:
    """FN-14: a number printed with two decimals."""
    return F.format_string("%.2f", F.col(x) if isinstance(x, str) else x)
