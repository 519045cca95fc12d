"""Small file operations on any folder that Spark can reach (Hadoop file
systems through the session, so object stores and HDFS alike)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it doesn't exist."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of a file, or of all files below a
    folder, sorted. Hidden files (``_``, ``.``) are left out, as Spark does."""
    fs, where = _at(spark, path)
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Move a folder to a name that isn't there yet; false if it is."""
    fs, where = _at(spark, old)
    to = spark._jvm.org.apache.hadoop.fs.Path(new)
    return not fs.exists(to) and fs.rename(where, to)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; none if it doesn't exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole: written under another name and
    renamed over the old one, so a reader sees either text."""
    fs, where = _at(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(fresh)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fresh, where, options)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, unless there is one."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        fs.create(where).close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """A folder that a Spark write has committed as a whole."""
    return exists(spark, f"{path}/_SUCCESS")
