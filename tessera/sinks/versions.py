"""Outputs replaced as a whole (SNK-2).

An output folder holds versions and one small pointer file. A job writes a new
version next to the others and moves the pointer when Spark has committed it,
so readers see the old output until the new one is whole, and a job that fails
on the way changes nothing they read. Old versions go after the pointer has
moved, all but the last ``keep``, so that a reader that has looked up the
pointer can finish.

    <path>/versions/<name>/...   one complete output each
    <path>/CURRENT               the name of the version to read
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tessera.sinks import store


def current(spark: SparkSession, path: str) -> str | None:
    """The folder to read, or none if nothing has been published."""
    name = store.read_text(spark, f"{path}/CURRENT")
    return f"{path}/versions/{name}" if name else None


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 1) -> str:
    """``write(folder)`` writes the new output; publish it and return its
    folder. ``keep`` versions before it stay readable. One writer at a time:
    what an earlier failed job left is deleted."""
    before = store.read_text(spark, f"{path}/CURRENT")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(f"{path}/versions/{name}")
    if not store.is_complete(spark, f"{path}/versions/{name}"):
        raise RuntimeError(f"the writer left no complete output in {path}/versions/{name}")
    store.write_text(spark, f"{path}/CURRENT", name)
    older = [v for v in store.children(spark, f"{path}/versions") if v < name and v != before]
    for v in older[:max(0, len(older) - max(0, keep - 1))]:
        store.delete(spark, f"{path}/versions/{v}")
    if before and keep == 0:
        store.delete(spark, f"{path}/versions/{before}")
    return f"{path}/versions/{name}"
