"""Incremental catalogue ingest with Structured Streaming.

New catalogue files dropped into a folder are split into records (the same
``lineSep`` text source as the batch reader), parsed with the same
expressions, and folded into additive per ``(group, customer)`` review
counters (AGG-15) kept in Spark's state store. Each micro-batch writes the
counters it changed to its own ``batch_id=N`` folder of a changelog;
``current_counters`` reads the changelog back with last-write-wins per key
(SNK-7). A replayed batch overwrites its own folder, so a retried batch after
an executor loss cannot change the result.

Everything (source checkpoint, state, changelog) lives in folders the
caller names, by default under the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tessera.operators.upsert import latest_by_key
from tessera.session import scratch_dir
from tessera.sources.records import RECORD_SEPARATOR, parse_records, reviews_of


def review_records_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming reviews parsed from catalogue files arriving in ``src_dir``."""
    reader = spark.readStream.format("text").option("lineSep", RECORD_SEPARATOR)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reviews_of(parse_records(reader.load(src_dir)))


def review_counters(reviews: DataFrame) -> DataFrame:
    """AGG-15: running review count per (group, customer)."""
    return reviews.groupBy("group", "customer").agg(F.count(F.lit(1)).alias("comments"))


# A commit uploads the changed rows instead of the store's files, and a put looks no row up only to count rows.
_STATE = "spark.sql.streaming.stateStore."
ROCKSDB = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}rocksdb.trackTotalNumberOfRows": "false",
}


def start_with_state(spark: SparkSession, writer: DataStreamWriter, rocksdb_state: bool) -> StreamingQuery:
    """Start ``writer``'s query; the settings of its state are read then, and
    the session has its own again afterwards."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    if rocksdb_state:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_review_counters(spark: SparkSession, src_dir: str, changelog_dir: str,
                          checkpoint_dir: str | None = None, available_now: bool = True,
                          rocksdb_state: bool = True) -> StreamingQuery:
    """Start the ingest; with ``available_now`` it processes every file present
    and stops (a scheduled incremental job), otherwise it keeps running.

    The counter state grows with the number of (group, customer) keys; with
    ``rocksdb_state`` it lives in RocksDB on executor disk (checkpointed to
    the checkpoint folder) instead of executor heap. The provider is fixed by
    the query's checkpoint, so keep the same setting across restarts.
    """
    counters = review_counters(review_records_stream(spark, src_dir))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changelog_dir.rstrip('/')}/batch_id={batch_id}")

    writer = (counters.writeStream.outputMode("update").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_dir or scratch_dir(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return start_with_state(spark, writer, rocksdb_state)


def current_counters(spark: SparkSession, changelog_dir: str) -> DataFrame:
    """Latest counter per (group, customer) from the changelog."""
    log = spark.read.parquet(changelog_dir)
    return latest_by_key(log, ["group", "customer"], "batch_id").select("group", "customer", "comments")


def compact_changelog(spark: SparkSession, changelog_dir: str, snapshot_dir: str) -> str:
    """Fold the changelog into a snapshot (one row per key, its last batch
    id kept), so readers stop paying for the whole history. Point the next
    ``current_counters`` at the snapshot plus the batches written after it:
    the snapshot rows carry their batch ids, so last-write-wins still holds."""
    log = spark.read.parquet(changelog_dir)
    latest_by_key(log, ["group", "customer"], "batch_id").write.mode("overwrite").parquet(snapshot_dir)
    return snapshot_dir
