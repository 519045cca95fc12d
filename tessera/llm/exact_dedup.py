"""Exact dedup as a stateful stream.

Documents are reduced to ``(digest, doc_id)`` where they are read; those rows
stream (``availableNow``, several micro-batches) into a keyed aggregation
whose state lives in RocksDB on disk, has no watermark and so never expires.
Per digest the state holds the stable identifier (the largest doc_id, which
is also the content locator: it names the row that has the bytes) and the
number of rows. Every micro-batch publishes the changed keys under its batch
id (a replayed batch overwrites its own folder); the last state of a key is
the one with the most rows.

Hits are checked on full bytes: of the texts of a digest that has more than one
row the least and the greatest are compared. Should two texts share a digest,
the rows of that digest are grouped again by digest and text.

The state lasts where the caller names a folder for it (``state_dir``): a later
delivery streams through the same state, and its rows are judged against all
deliveries so far.

Partial aggregation runs before each shuffle, so a digest that holds a third
of all rows reaches the state as one row per task; the joins on the digest
are plain equi-joins that adaptive execution splits when a key is hot.

Defined results: a null text is the empty text. Rows with a null doc_id take
part; they stay only in a group without any id (``keep_id`` null). Rows that
repeat a doc_id and its text are one document and get one verdict. An empty table gives
an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import near_ids, staged, write_stage
from tessera.session import scratch_dir
from tessera.sinks import store

#: Micro-batches that one run is dealt into.
BATCHES = 3
#: Distinct values of the digest prefix that picks the texts to compare: the
#: broadcast set has at most 2**PREFIX_BITS rows, whatever the input.
PREFIX_BITS = 20
#: Rows per state partition. A RocksDB instance takes some MB of disk before it
#: holds anything, so their number follows the rows, not the shuffle setting.
STATE_ROWS = 2_000_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def key_state(rows: DataFrame) -> DataFrame:
    """The keyed state: per digest the kept id, the locator and the rows so far."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def run_stream(spark: SparkSession, path: str, schema, batches: int = BATCHES, work: str | None = None) -> DataFrame:
    """All files of ``path`` that the state in ``work`` has not seen through
    the stateful aggregation; the state then. Without ``work`` the state is of
    this call alone."""
    stored = spark.read.schema(schema).parquet(path)
    per_batch = max(1, -(-len(stored.inputFiles()) // batches))
    work = work or scratch_dir(spark, "dedup-stream")
    stores = store.read_text(spark, f"{work}/stores")  # a state keeps its number of partitions
    if stores is None:
        stores = str(max(spark.sparkContext.defaultParallelism, -(-stored.count() // STATE_ROWS)))
        store.write_text(spark, f"{work}/stores", stores)
    settings = STATE_CONF | {"spark.sql.streaming.internal.stateStore.partitions": stores}

    def publish(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{work}/changes/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
        query = (key_state(rows).writeStream.outputMode("update").foreachBatch(publish)
                 .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    state = "digest binary, keep_id long, group_size long"
    try:
        seen = spark.read.schema(state + ", batch int").parquet(f"{work}/changes")
        seen.take(1)
    except Exception as e:  # noqa: BLE001 - no batch ran: an empty input
        if "PATH_NOT_FOUND" not in str(e):
            raise
        seen = spark.createDataFrame([], state)
    return seen.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))


def _prefix(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 3)), 16, 10).cast("int") % (1 << PREFIX_BITS)


def mismatches(texts: DataFrame, state: DataFrame, digest) -> DataFrame:
    """Digests that different texts have: of the texts of a digest the least
    and the greatest bytes differ. Both are kept per task before the shuffle,
    so a text that a third of all rows share is sent once a task."""
    hits = state.filter("group_size > 1")
    prefixes = F.broadcast(hits.select(_prefix(F.col("digest")).alias("prefix")).distinct())
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"), digest(F.col("text")).alias("digest"))
    near = texts.join(prefixes, _prefix(texts.digest) == prefixes.prefix, "left_semi")
    ends = near.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    return ends.filter("least != greatest").select("digest")


def dedup(docs: DataFrame, digest=sha256, batches: int = BATCHES, state_dir: str | None = None, delivery: str = "",
          earlier: DataFrame | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest for each row of ``docs``.

    With ``state_dir`` the state stays there, and a later call judges its rows
    against all deliveries so far. ``delivery`` names the call's rows: the
    same name again, after a failure, adds nothing twice. ``earlier`` has the
    rows (doc_id, text) of deliveries before, whose bytes are compared on
    hits; without it only the rows of this call are."""
    spark = docs.sparkSession
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    if state_dir:
        path, every = f"{state_dir}/digests/of-{delivery}", f"{state_dir}/digests/*"
        if not delivery:
            raise ValueError("a lasting state needs the name of the delivery")
        if not store.is_complete(spark, path):
            keys.write.mode("overwrite").parquet(path)
    else:
        path = every = write_stage(keys, "digests")
    keys = spark.read.schema(keys.schema).parquet(path)
    state = staged(run_stream(spark, every, keys.schema, batches, state_dir), "dedup-state")
    out = keys.join(state, "digest")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if earlier is not None:
        texts = texts.unionByName(earlier.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    bad = staged(mismatches(texts, state, digest), "dedup-mismatches")
    if not bad.isEmpty():
        rows = lambda t: t.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                                  digest(F.col("text")).alias("digest")).join(bad, "digest", "left_semi")
        again = rows(texts).groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = out.join(bad, "digest", "left_anti").unionByName(rows(docs).join(again, ["digest", "text"]).drop("text"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def keep_one(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs`` that stay, own columns only."""
    gone = staged(dedup(docs, batches=batches).filter("NOT kept").select("doc_id", "digest").distinct(), "dedup-dropped")
    near = near_ids(docs, gone)
    same = (near["doc_id"].cast("long").eqNullSafe(gone["doc_id"])) & (sha256(near["text"]) == gone["digest"])
    return near_ids(docs, gone, hit=False).unionByName(near.join(gone, same, "left_anti"))
