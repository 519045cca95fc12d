"""Importance resampling towards a target distribution by hashed n-grams.

Features are the runs of 1 to 3 consecutive words of a text; a feature's
bucket is the CRC-32 of its bytes modulo ``BUCKETS``. Counts of all documents
and of all target texts give every bucket a gain, a document's weight is the
sum of its features' gains, and the documents of highest weight plus Gumbel
noise are drawn (sampling without replacement in proportion to e^weight/1000).

CRC-32 is linear over bits: the checksum of a string is the exclusive-or of a
constant of its length and of one contribution per byte, which depends on the
byte and on its distance from the end. Both are looked up in tables, and
``np.bitwise_xor.reduceat`` adds up the contributions over all feature spans
of a block of words at once. The 1-, 2- and 3-word features that end at one
word share that end, so each byte of the longest is looked up once and the
spans are cut at the word starts. A span of more than ``NEAR`` bytes is folded
blockwise: the checksum so far is carried over a block by four lookups.

Spark deals out the texts, adds up the bucket counts (at most ``BUCKETS`` rows
a task, combined before the shuffle) and ranks by ranges. The driver holds the
``BUCKETS`` counts of either side and nothing that grows with the documents.
The texts are read twice, once to count and once to weigh.

Defined results: a null text has no words and weight 0; with fewer words than
``min_words`` a document is never drawn. Rows that repeat a doc_id each take
part and get a row; they share their noise, rows that tie on score and doc_id
are ranked by the rest of the row. A null doc_id is hashed as an empty string
and comes first on ties. Empty tables: no documents give no rows, no target
texts a target without counts. Columns but ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, slices, staged, text_bytes, word_spans
from tessera.operators.ordering import with_position

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of a span that are looked up by distance; longer spans are folded in
#: blocks of so many.
NEAR = 128
#: Bytes of text, and looked-up bytes, that a task handles at a time.
SLICE, LOOKUPS = 4 << 20, 1 << 21

#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

_codes = np.arange(256)
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)
#: Bytes of words: digits, letters and all of UTF-8's longer forms.
WORD = ((_codes >= 0x30) & (_codes <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_codes >= 0x80)


def position_tables() -> tuple[np.ndarray, np.ndarray]:
    """``near[d, b]``, what byte ``b`` at ``d`` bytes from the end adds to a
    checksum, and ``rest[n]``, the register after ``n`` zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
    near = np.empty((NEAR, 256), np.uint32)
    near[0] = step
    rest = np.empty(NEAR + 1, np.uint32)
    rest[0] = 0xFFFFFFFF
    for d in range(1, NEAR):
        near[d] = (near[d - 1] >> 8) ^ step[near[d - 1] & 0xFF]
    for n in range(1, NEAR + 1):
        rest[n] = (rest[n - 1] >> np.uint32(8)) ^ step[rest[n - 1] & np.uint32(0xFF)]
    return near, rest


NEAR_TABLE, REST = position_tables()


def _spans_xor(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Contributions of the bytes ``lo[i]..hi[i]`` by their distance from
    ``hi[i]``, added up between the ``cuts`` (indices into the spans laid one
    after the other, each span's start among them)."""
    size = hi - lo
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(lo - begin, size)
    far = np.repeat(hi - 1, size) - at
    return np.bitwise_xor.reduceat(NEAR_TABLE.ravel()[(far << 8) | data[at]], cuts)


def _carry(register: np.ndarray) -> np.ndarray:
    """Registers after ``NEAR`` more zero bytes."""
    out = np.zeros_like(register)
    for i in range(4):
        out ^= NEAR_TABLE[NEAR - 1 - i][(register >> np.uint32(8 * i)) & np.uint32(0xFF)]
    return out


def folded_crc(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """CRC-32 of the non-empty spans ``lo..hi``, of any length, blockwise: the
    first block takes the odd bytes, all others are whole."""
    head = (hi - lo - 1) % NEAR + 1
    register = _spans_xor(data, lo, lo + head, np.cumsum(head) - head) ^ REST[head]
    at, live = lo + head, np.arange(len(lo))
    while True:
        live = live[at[live] < hi[live]]
        if not len(live):
            return register ^ np.uint32(0xFFFFFFFF)
        block = _spans_xor(data, at[live], at[live] + NEAR, np.arange(len(live)) * NEAR)
        register[live] = _carry(register[live]) ^ block
        at[live] += NEAR


def span_crc(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """CRC-32 of each non-empty span of ``data``, in blocks of ``LOOKUPS``."""
    out = np.empty(len(lo), np.uint32)
    ends = np.cumsum(hi - lo)
    first = 0
    while first < len(lo):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LOOKUPS, side="right")))
        out[first:last] = folded_crc(data, lo[first:last], hi[first:last])
        first = last
    return out


def joined_words(data: np.ndarray, offsets: np.ndarray):
    """The lower-cased words of all texts, each followed by one space: bytes,
    starts and ends of the words, and their texts."""
    starts, ends, text = word_spans(data, offsets, WORD)
    size = ends - starts
    out = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = LOWER[data[WORD[data]]]
    end = np.cumsum(size + 1) - 1
    return out, end - size, end, text


def feature_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``crc[k, n]`` of the feature of ``n + 1`` words that ends with word
    ``k``, and whether there is one (``place`` is the word's place in its text)."""
    words, n = len(start), LONGEST
    crc, there = np.zeros((words, n), np.uint32), place[:, None] >= np.arange(n)
    first = np.empty((words, n), np.int64)
    for i in range(n):
        first[:, i] = start[np.maximum(np.arange(words) - i, 0)]
    lo = np.where(there, first, end[:, None]).min(axis=1)
    far = end - lo > NEAR
    ends = np.cumsum(np.where(far, 0, end - lo))
    a = 0
    while a < words:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LOOKUPS, side="right")))
        k = a + np.flatnonzero(~far[a:b])
        a = b
        if not len(k):
            continue
        size = end[k] - lo[k]
        begin = np.cumsum(size) - size
        order = np.arange(n)[::-1]  # the longest feature begins first
        cuts = (begin[:, None] + first[k][:, order] - lo[k][:, None])[there[k][:, order]]
        parts = np.zeros((len(k), n), np.uint32)
        parts[there[k][:, order]] = _spans_xor(data, lo[k], end[k], cuts)
        crc[k] = np.bitwise_xor.accumulate(parts[:, ::-1], axis=1)
        crc[k] ^= REST[np.where(there[k], end[k][:, None] - first[k], 0)] ^ np.uint32(0xFFFFFFFF)
    if far.any():
        k, i = np.nonzero(there & far[:, None])
        crc[k, i] = span_crc(data, first[k, i], end[k])
    return crc, there


def _blocks(batches):
    """Per block of texts: the Arrow batch's rows it covers, the bucket of
    each word's features, whether there is one, and each word's text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, SLICE):
            part, own = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            joined, start, end, text = joined_words(part, own)
            n_words = np.bincount(text, minlength=b - a)
            place = np.arange(len(text)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
            crc, there = feature_crcs(joined, start, end, place)
            yield batch.slice(a, b - a), (crc % np.uint32(BUCKETS)).astype(np.int64), there, n_words


def _count(batches):
    import pyarrow as pa

    total = np.zeros(BUCKETS, np.int64)
    for _, bucket, there, _ in _blocks(batches):
        total += np.bincount(bucket[there], minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all ``texts`` per bucket. ``BUCKETS`` numbers reach the driver."""
    bounded_batches(texts.sparkSession)
    rows = texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_count, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of target to documents, smoothed by one, in
    thousandths."""
    s, t = documents.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row of ``docs``."""
    bounded_batches(docs.sparkSession)

    def weigh(batches):
        import pyarrow as pa

        for rows, bucket, there, n_words in _blocks(batches):
            sums = np.concatenate([[0], np.cumsum(np.where(there, gain[bucket], 0).sum(axis=1))])
            last = np.cumsum(n_words)
            features = sum(np.maximum(n_words - i, 0) for i in range(LONGEST))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n_words), pa.array(features), pa.array(sums[last] - sums[last - n_words])],
                ["doc_id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document in thousandths, from a hash of its id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Each row's doc_id, n_features, weight, score and rank among the drawn
    (null if not drawn): ``percent`` of the documents with ``min_words``."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    score = (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")
    rows = staged(weighed(docs, gain).select("doc_id", "n_words", "n_features", "weight", score), "weighed")
    able = rows.filter(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = with_position(able, [F.col("score").desc(), F.col("doc_id").asc()], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = rows.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest)
