"""The most active customers of every group, kept up to date (WIN-3).

The stream adds up reviews per (group, customer) in its state, as ``ingest``
does, and after every micro-batch a list of the n best of each group is
brought up to date from the list before and the counts that changed; the
counts of all other customers are not read. That is exact because counts only
grow: a customer whose count didn't change and who wasn't among the n best
before can't be among them now. (Where products are delivered again with
fewer reviews, counts shrink: ``corrections`` keeps such counters, and the
list is a query on them.)

A list is n rows a group, in a folder named by its micro-batch; a replayed
micro-batch starts from the same list and replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.topk import top_n_per_group
from tessera.session import scratch_dir
from tessera.sinks import store
from tessera.streaming.ingest import review_counters, review_records_stream, start_with_state

KEPT = 2  # lists that stay: the newest, and the one a replay of it starts from


def _lists(spark: SparkSession, top_dir: str) -> list[int]:
    names = [n for n in store.children(spark, top_dir) if n.startswith("batch_id=") and store.is_complete(spark, f"{top_dir}/{n}")]
    return sorted(int(n.split("=")[1]) for n in names)


def best(counts: DataFrame, n: int) -> DataFrame:
    """At most n customers of each group, most reviews first, then by name;
    of several counts of one customer the largest, which is the latest."""
    latest = counts.groupBy("group", "customer").agg(F.max("comments").alias("comments"))
    return top_n_per_group(latest, ["group"], [F.col("comments").desc(), F.col("customer").asc()], n)


def start_top_reviewers(spark: SparkSession, src_dir: str, top_dir: str, n: int = 10, checkpoint_dir: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        rocksdb_state: bool = True) -> StreamingQuery:
    """Start the ingest of catalogue files; the lists are written below
    ``top_dir``. Keep ``n`` and the state setting across restarts."""
    counters = review_counters(review_records_stream(spark, src_dir, max_files_per_trigger))

    def publish(changed: DataFrame, batch_id: int) -> None:
        before = [b for b in _lists(spark, top_dir) if b < batch_id]
        rows = changed.select("group", "customer", "comments")
        if before:
            rows = rows.unionByName(spark.read.parquet(f"{top_dir}/batch_id={before[-1]}"))
        best(rows, n).write.mode("overwrite").parquet(f"{top_dir}/batch_id={batch_id}")
        for old in before[:-(KEPT - 1)]:
            store.delete(spark, f"{top_dir}/batch_id={old}")

    writer = (counters.writeStream.outputMode("update").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_dir or scratch_dir(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return start_with_state(spark, writer, rocksdb_state)


def top_reviewers_now(spark: SparkSession, top_dir: str) -> DataFrame:
    """The newest lists: (group, customer, comments)."""
    batches = _lists(spark, top_dir)
    if not batches:
        raise ValueError(f"no list in {top_dir}")
    return spark.read.parquet(f"{top_dir}/batch_id={batches[-1]}")
