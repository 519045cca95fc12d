"""Review counters that accept corrections (AGG-15).

A product may be delivered again: unchanged, corrected (reviews added, taken
away or moved to another group) or discontinued. The stream keeps each
product's last delivery in a log next to its checkpoint: every micro-batch
writes the deliveries that hold in it to its own folder. What a product counted
before is its delivery in the newest earlier folder that names it, and a new
delivery yields only the signed difference: its reviews count 1 and those it
replaces -1. The differences of a micro-batch are added up by (group, customer)
and written as one batch of partials (``sinks.partials``). A replayed
micro-batch replaces its own folders and starts from the same earlier ones, and
the counters at any time are the sums of all differences: the same as a recount
of the last delivery of every product.

Which delivery of a product is the last: the one in the later micro-batch,
within one the one in the newer file (modification time, then path). Records
of one product in the same file add up, as they do in a recount. Defined
results: a product without reviews, or a discontinued one, counts nothing; a
missing group or customer is a key of its own (null); a record without an Id is not
read.

A micro-batch shuffles its own deliveries and, of the log, those of the same
products; all of it is Spark joins and aggregates, with no Python per product.
The log holds one row per record of a product's last delivery; after ``FOLD``
micro-batches the folders before are folded into a base without the replaced
deliveries, so it grows with the products and not with the deliveries.

    <checkpoint>/last-deliveries/batches/batch=<id>/...
    <checkpoint>/last-deliveries/base/through=<id>/...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.session import scratch_dir
from tessera.sinks import partials, store
from tessera.sources.records import RECORD_SEPARATOR, parse_records, review_customers

KEYS, SUMS = ["group", "customer"], ["comments"]
FOLD = 10  # folders of the log that are read besides the base


def deliveries(records: DataFrame) -> DataFrame:
    """(Id, group, customers, at, file) of every record of text rows that
    carry their file's time and path (``at``, ``file``)."""
    products = parse_records(records, carry=["at", "file"], keep_discontinued=True)
    return products.select("Id", "group", review_customers(F.col("review_lines")).alias("customers"), "at", "file")


def delivery_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Deliveries parsed from catalogue files arriving in ``src_dir``."""
    reader = spark.readStream.format("text").option("lineSep", RECORD_SEPARATOR)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(src_dir)
    return deliveries(rows.select("value", F.col("_metadata.file_modification_time").alias("at"),
                                  F.col("_metadata.file_path").alias("file")))


def _last(rows: DataFrame, at: list[str]) -> DataFrame:
    """Of every product the records of its last delivery by ``at``."""
    order = F.struct(*at)
    newest = F.max(order).over(Window.partitionBy("Id"))
    return rows.withColumn("newest", newest).filter(order == F.col("newest")).drop("newest")


def _log_before(spark: SparkSession, log: str, batch_id: int) -> tuple[DataFrame | None, list[int]]:
    """The log's rows (Id, group, customers, batch) before a micro-batch, and
    its folders that no base holds."""
    through = [b for b in partials.numbers(spark, f"{log}/base", "through=", True) if b < batch_id]
    base = max(through, default=None)
    later = [b for b in partials.numbers(spark, f"{log}/batches", "batch=", True) if b < batch_id and (base is None or b > base)]
    parts = [f"{log}/batches/batch={b}" for b in later] + ([f"{log}/base/through={base}"] if base is not None else [])
    return (spark.read.parquet(*parts) if parts else None), later


def _fold(spark: SparkSession, log: str, batch_id: int) -> None:
    """Fold the folders before a micro-batch into a base, if there are many.
    They are of finished micro-batches, which aren't replayed."""
    rows, later = _log_before(spark, log, batch_id)
    if len(later) < FOLD:
        return
    _last(rows, ["batch"]).write.mode("overwrite").parquet(f"{log}/base/through={later[-1]}")
    for folder, prefix, upto in (("batches", "batch=", later[-1]), ("base", "through=", later[-1] - 1)):
        for b in partials.numbers(spark, f"{log}/{folder}", prefix, False):
            if b <= upto:
                store.delete(spark, f"{log}/{folder}/{prefix}{b}")


def differences(spark: SparkSession, log: str, batch_id: int) -> DataFrame:
    """(group, customer, comments) that the deliveries of a micro-batch, as
    logged, add to and take from what their products counted before."""
    now = spark.read.parquet(f"{log}/batches/batch={batch_id}")
    before, _ = _log_before(spark, log, batch_id)
    count = lambda rows, n: rows.select("group", "customers", F.lit(n).cast("long").alias("comments"))
    signed = count(now, 1)
    if before is not None:
        replaced = _last(before.join(now.select("Id").distinct(), "Id", "left_semi"), ["batch"])
        signed = signed.unionByName(count(replaced, -1))
    reviews = signed.select("group", F.explode("customers").alias("customer"), "comments")
    return reviews.groupBy(*KEYS).agg(F.sum("comments").alias("comments")).filter(F.col("comments") != 0)


def start_corrected_counters(spark: SparkSession, src_dir: str, table_dir: str, checkpoint_dir: str | None = None,
                             available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest into the partials of ``table_dir``; with
    ``available_now`` it processes every file present and stops. The
    checkpoint folder holds the log of last deliveries: name it to go on in a
    later run."""
    state = checkpoint_dir or scratch_dir(spark, "stream-ckpt")
    log = f"{state.rstrip('/')}/last-deliveries"

    def publish(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        _fold(own, log, batch_id)
        last = _last(batch, ["at", "file"]).select("Id", "group", "customers", F.lit(batch_id).cast("long").alias("batch"))
        last.write.mode("overwrite").parquet(f"{log}/batches/batch={batch_id}")
        # replayed after it was folded, a micro-batch has the same differences: its folder is not read again
        partials.add_batch(differences(own, log, batch_id), table_dir, batch_id, replay=True)

    writer = (delivery_stream(spark, src_dir, max_files_per_trigger).writeStream.foreachBatch(publish)
              .option("checkpointLocation", state))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def corrected_counters(spark: SparkSession, table_dir: str) -> DataFrame:
    """Reviews per (group, customer) now; pairs without any are gone."""
    return partials.merged(spark, table_dir, KEYS, SUMS)


def compact_counters(spark: SparkSession, table_dir: str) -> int:
    """Fold the differences so far into a base in answer order (most active
    customers of a group first); the stream may run on meanwhile."""
    return partials.compact(spark, table_dir, KEYS, SUMS, cluster_by=["group"], order=[F.col("comments").desc(), F.col("customer").asc()])
