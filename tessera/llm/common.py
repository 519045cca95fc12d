"""Helpers shared by the operators: reading, staging, free column names."""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

#: Fixed value: white space that separates words.
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of ``sf_dir``, as Spark splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Cap the rows of an Arrow batch, so that a worker holds few texts at a
    time. A session whose setting is smaller already is left alone."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def write_stage(df: DataFrame, name: str) -> str:
    """``df`` written once to a new folder of the shared scratch folder."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: cuts the lineage, and a lost executor
    costs no more than a reread."""
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, name))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't use."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body).getItem(0)


def per_process(key: str, make):
    """One object per Python worker process (tokenizers are slow to load).
    Shipped functions have no module globals of their own to keep it in."""
    kept = sys.__dict__.setdefault("_tessera_llm_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


#: Slots of the broadcast that narrows rows down before an exact join: it has
#: at most this many rows, whatever the input.
SLOTS = 1 << 20


def near_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id", hit: bool = True) -> DataFrame:
    """Rows of ``docs`` whose id's slot is (``hit``), or isn't, among the slots
    of ``ids``. A cheap first cut that keeps other rows' texts out of the
    shuffle; an exact join follows."""
    def slot(c):
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(SLOTS))

    name = free_name(docs, "slot")
    slots = F.broadcast(ids.select(slot(F.col(ids.columns[0])).alias(name)).distinct())
    return docs.join(slots, slot(docs[key]) == slots[name], "left_semi" if hit else "left_anti")


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in the one column of ``ids``."""
    near = near_ids(docs, ids)
    return near.join(ids, near["doc_id"].cast("long") == ids[ids.columns[0]], "left_semi")


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in the one column of ``ids``."""
    near = near_ids(docs, ids)
    far = near_ids(docs, ids, hit=False)
    return far.unionByName(near.join(ids, near["doc_id"].cast("long") == ids[ids.columns[0]], "left_anti"))


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array without nulls, as they lie in
    its buffer, and the texts' offsets (one more than texts)."""
    size = np.int64 if str(texts.type).startswith("large") else np.int32
    ends = np.frombuffer(texts.buffers()[1], size)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words, and the number of the text
    each lies in; a word is a run of bytes for which ``member`` holds and ends
    with its text."""
    inside = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after_gap, before_gap = edge[:-1].copy(), edge[1:].copy()
    after_gap[1:] |= ~inside[:-1]
    before_gap[:-1] |= ~inside[1:]
    starts = np.flatnonzero(inside & after_gap)
    ends = np.flatnonzero(inside & before_gap) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def slices(offsets: np.ndarray, size: int):
    """(first, last) ranges of consecutive texts that hold about ``size``
    bytes each; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)
