"""Parsed records that several queries and sessions share (SRC-13).

A derived table is kept in a shared folder under a fingerprint: of the source
files (paths, lengths, modification times) and of the code that derives it. A
query with the same sources and code reads what is there; a changed file or a
changed parser has another fingerprint, so it is derived anew. The table is
written under another name and renamed when complete, so a failed or a
parallel job never leaves half a table; of two jobs that derive the same at
once, the first to finish counts. Nothing is remembered in the process: the
files are looked up each time.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable, Sequence
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from tessera.session import shared_dir
from tessera.sinks import store
from tessera.sources import records


def fingerprint(spark: SparkSession, paths: Sequence[str], code: Sequence[ModuleType | Callable]) -> str:
    """Of the files below ``paths`` and the source of ``code``. A path
    without files has one too; a path that isn't there raises."""
    digest = hashlib.sha256()
    for path in paths:
        for file in store.listing(spark, path):
            digest.update(repr(file).encode())
        digest.update(b"\0")
    for part in code:
        digest.update(inspect.getsource(part).encode())
    return digest.hexdigest()[:32]


def derived(spark: SparkSession, name: str, paths: Sequence[str], code: Sequence[ModuleType | Callable],
            write: Callable[[str], None], root: str | None = None) -> str:
    """The folder that ``write(folder)`` has written, or now writes, for
    these sources and this code, below ``root`` (by default the session's
    shared folder)."""
    folder = f"{(root or shared_dir(spark)).rstrip('/')}/tessera-derived-{name}-{fingerprint(spark, paths, code)}"
    if not store.is_complete(spark, folder):
        fresh = f"{folder}.{uuid.uuid4().hex}"
        write(fresh)
        if not store.rename(spark, fresh, folder):
            store.delete(spark, fresh)
    return folder


def parsed_base(spark: SparkSession, text: str, root: str | None = None) -> DataFrame:
    """SRC-2 .. SRC-4, once per state of the catalogue file(s) ``text``: the
    parsed products, for any number of questions."""
    def write(folder: str) -> None:
        records.parse_records(records.read_records(spark, text)).write.parquet(folder)

    return spark.read.parquet(derived(spark, "products", [text], [records], write, root))
