"""Masked pseudo-likelihood with a bidirectional window network.

Words are hashed to ``VOCAB`` buckets. For each position a small network sees
the buckets of the two words on either side, never the word itself, and
predicts its bucket in two steps (class, then member of the class). The third
step is the word within its bucket, from the counts of all words of the
corpus: of a bucket with ``t`` positions, a word counted ``c`` times has
``c / (t + 1)`` and a word never counted ``1 / (t + 1)``. The sum of the
conditional log-probabilities over all positions scores a document.

Training is numpy inside Spark tasks and covers the whole corpus once: the
rows are dealt into ``ROUNDS`` parts by a hash; in a round every task takes
Adagrad steps over its rows of that part from the shared parameters, and the
results are averaged, weighted by positions, in a shuffle by parameter block
(sorted, so sums have a fixed order). The driver sees only the averaged
parameters of the network, whose size doesn't depend on the data.

The word counts do grow with the corpus: Spark adds them up and keeps them as
Parquet. Scoring evaluates the network, the bucket totals and the counts of
the most frequent words (``HELD`` at most) where a text is read; the counts of
all other words are joined to each text's words in a shuffle. Log counts are
whole multiples of ``1 / UNIT``, so their sums don't depend on the order.

Defined results: a null or blank text has 0 tokens, score 0 and a null mean.
Repeated rows score alike, a null id is passed through, an empty table gives
an empty result; columns but ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, staged

CLASSES, MEMBERS = 32, 32
VOCAB = CLASSES * MEMBERS
HIDDEN = 16
OFFSETS = (-2, -1, 1, 2)
ROUNDS = 3
#: Positions of a training step, and positions that are scored together.
STEP, TOGETHER = 4096, 1 << 12
RATE = 0.1
SEED = 5
#: Parameters per shuffled block.
BLOCK = 1024
#: Bytes of a word that is its own key.
SHORT = 16
#: Word counts that a scoring task holds at most.
HELD = 1 << 16
UNIT = 1 << 24
#: Words and bytes of text after which a task passes its counts on.
FLUSH_WORDS, FLUSH_BYTES = 1 << 17, 1 << 26


def shapes() -> dict[str, tuple[int, ...]]:
    return {"table": (len(OFFSETS), VOCAB + 1, HIDDEN), "bias": (HIDDEN,), "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,),
            "member_w": (CLASSES, HIDDEN, MEMBERS), "member_b": (CLASSES, MEMBERS)}


def flat_size() -> int:
    return sum(math.prod(s) for s in shapes().values())


def unpack(flat) -> dict:
    out, at = {}, 0
    for k, s in shapes().items():
        out[k] = flat[at:at + math.prod(s)].reshape(s)
        at += math.prod(s)
    return out


def initial():
    import numpy as np

    rng = np.random.default_rng(SEED)
    flat = np.zeros(flat_size(), np.float32)
    p = unpack(flat)
    for k in ("table", "class_w", "member_w"):
        p[k][...] = rng.normal(0, 0.1, p[k].shape)
    return flat


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_key(word: bytes) -> bytes:
    """What a word is counted and joined by: long words have a digest, whose
    20 bytes no short word has."""
    return word if len(word) <= SHORT else hashlib.blake2b(word, digest_size=20).digest()


def word_buckets(found: list[bytes]):
    """The buckets of words; in 16 bits, which numpy sorts by radix."""
    import numpy as np

    return (np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) % VOCAB).astype(np.int16)


def buckets(text: str | None):
    return word_buckets(words(text))


def windows(seq):
    """The context buckets of each position, one row per offset; ``VOCAB``
    stands for no word."""
    import numpy as np

    reach = max(OFFSETS)
    wide = np.concatenate([np.full(reach, VOCAB, seq.dtype), seq, np.full(reach, VOCAB, seq.dtype)])
    return np.stack([wide[reach + o:reach + o + len(seq)] for o in OFFSETS])


def _log_share(z, at, target):
    """Log of the softmax of each row at its target; ``z`` is used up."""
    import numpy as np

    z -= z.max(axis=1, keepdims=True)
    out = z[at, target].astype(np.float64)
    np.exp(z, out=z)
    return out - np.log(z.sum(axis=1))


def hidden(p, context):
    import numpy as np

    h = p["bias"] + p["table"][0][context[0]]
    for k in range(1, len(OFFSETS)):
        h += p["table"][k][context[k]]
    return np.tanh(h)


def _softmax(z):
    """In place."""
    import numpy as np

    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def by_class(target):
    """An order of the positions by class, and each class's part of it."""
    import numpy as np

    which = target // MEMBERS
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(CLASSES + 1))
    return order, [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def member_scores(p, h, target, parts):
    """Scores of the members of each position's class; positions in the order
    of classes, one product a class."""
    import numpy as np

    z = p["member_b"][target // MEMBERS]
    for c, part in parts:
        z[part] += h[part] @ p["member_w"][c]
    return z


def log_probabilities(p, target, context):
    """log P(word | both sides) of each position."""
    import numpy as np

    order, parts = by_class(target)
    at, target = np.arange(len(target)), target[order]
    h = hidden(p, context[:, order])
    made = _log_share(h @ p["class_w"] + p["class_b"], at, target // MEMBERS)
    made += _log_share(member_scores(p, h, target, parts), at, target % MEMBERS)
    out = np.empty(len(target))
    out[order] = made
    return out


class Trainer:
    """Adagrad steps on the parameters."""

    def __init__(self, flat):
        import numpy as np

        self.flat = flat.copy()
        self.p, self.seen = unpack(self.flat), unpack(np.full(len(flat), 1.0, np.float32))

    def _step(self, name, at, grad) -> None:
        import numpy as np

        seen = self.seen[name]
        seen[at] += grad * grad
        self.p[name][at] -= RATE * grad / np.sqrt(seen[at])

    def learn(self, target, context) -> None:
        import numpy as np

        p = self.p
        order, parts = by_class(target)
        at, target, context = np.arange(len(target)), target[order], context[:, order]
        h = hidden(p, context)
        z = _softmax(h @ p["class_w"] + p["class_b"])
        z[at, target // MEMBERS] -= 1
        m = _softmax(member_scores(p, h, target, parts))
        m[at, target % MEMBERS] -= 1
        dh = z @ p["class_w"].T
        member_w, member_b = np.zeros_like(p["member_w"]), np.zeros_like(p["member_b"])
        for c, part in parts:
            member_w[c] = h[part].T @ m[part]
            dh[part] += m[part] @ p["member_w"][c].T
        member_b[[c for c, _ in parts]] = np.add.reduceat(m, [part.start for _, part in parts], axis=0)
        dh *= 1 - h * h
        steps = [("class_w", ..., h.T @ z), ("class_b", ..., z.sum(axis=0)), ("member_w", ..., member_w), ("member_b", ..., member_b),
                 ("bias", ..., dh.sum(axis=0))]
        for k in range(len(OFFSETS)):
            by = np.argsort(context[k], kind="stable")
            found = context[k][by]
            first = np.flatnonzero(np.diff(found, prepend=-1))
            steps.append(("table", (k, found[first]), np.add.reduceat(dh[by], first, axis=0)))
        for step in steps:
            self._step(*step)


def chunks(texts, size: int = STEP):
    """(target, context) arrays of about ``size`` positions over many texts."""
    import numpy as np

    held, n = [], 0
    for t in texts:
        seq = buckets(t)
        if not len(seq):
            continue
        context = windows(seq)
        for i in range(0, len(seq), size):
            held.append((seq[i:i + size], context[:, i:i + size]))
            n += len(held[-1][0])
            if n >= size:
                yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held], axis=1)
                held, n = [], 0
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held], axis=1)


def _train(flat):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        trainer, n = Trainer(flat), 0
        for target, context in chunks(t.as_py() for b in batches for t in b.column("text")):
            trainer.learn(target, context)
            n += len(target)
        if n:
            parts = [trainer.flat[i:i + BLOCK].astype("<f4").tobytes() for i in range(0, len(flat), BLOCK)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(np.full(k, TaskContext.get().partitionId()), pa.int32()),
                                              pa.array(np.full(k, n), pa.int64()), pa.array(parts, pa.binary())],
                                             names=["block", "task", "n", "part"])
    return run


def _average(batches):
    """Weighted means of the blocks of a sorted run, one block at a time."""
    import numpy as np
    import pyarrow as pa

    now, total, weight, out = None, None, 0, []

    def done():
        out.append((now, weight, (total / weight).astype("<f4").tobytes()))

    for b in batches:
        for block, n, part in zip(b.column("block").to_pylist(), b.column("n").to_pylist(), b.column("part")):
            if block != now:
                if now is not None:
                    done()
                now, total, weight = block, 0.0, 0
            total = total + np.frombuffer(part.as_py(), "<f4").astype(np.float64) * n
            weight += n
    if now is not None:
        done()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()),
                                          pa.array([x[2] for x in out], pa.binary())], names=["block", "n", "part"])


def train(docs: DataFrame, rounds: int = ROUNDS):
    """The parameters after one pass over all texts, in ``rounds`` parts."""
    import numpy as np

    bounded_batches(docs.sparkSession)
    flat = initial()
    texts = docs.select("text", F.pmod(F.xxhash64("text"), F.lit(rounds)).alias("part"))
    for r in range(rounds):
        mine = texts.filter(F.coalesce("part", F.lit(0)) == r).select("text")
        parts = mine.mapInArrow(_train(flat), "block int, task int, n long, part binary")
        means = parts.repartition("block").sortWithinPartitions("block", "task").mapInArrow(_average, "block int, n long, part binary")
        rows = sorted(means.collect())  # the parameters: a fixed size
        if rows:
            flat = np.concatenate([np.frombuffer(x.part, "<f4") for x in rows]).astype(np.float32)
    return flat


def _count(batches):
    import pyarrow as pa

    held, size = Counter(), 0

    def counted():
        return pa.RecordBatch.from_arrays([pa.array([word_key(w) for w in held], pa.binary()), pa.array([zlib.crc32(w) % VOCAB for w in held], pa.int32()),
                                           pa.array(list(held.values()), pa.int64())], names=["word", "bucket", "n"])

    for b in batches:
        for t in b.column("text"):
            found = words(t.as_py())
            held.update(found)
            size += sum(map(len, found))
            if len(held) >= FLUSH_WORDS or size >= FLUSH_BYTES:
                yield counted()
                held, size = Counter(), 0
    if held:
        yield counted()


def count_words(docs: DataFrame) -> DataFrame:
    """word (its key), bucket and n of every word of the corpus."""
    bounded_batches(docs.sparkSession)
    found = docs.select("text").mapInArrow(_count, "word binary, bucket int, n long")
    return staged(found.groupBy("word", "bucket").agg(F.sum("n").alias("n")), "lm-words")


def scores(p, found: list[list[bytes]], spread=None) -> list[tuple[int, float]]:
    """(positions, summed log-probabilities) of each text's words; the
    positions of many texts are evaluated together. ``spread`` has a value per
    bucket that is added for each of its positions."""
    import numpy as np

    size, total, held, n = [], [], [], 0

    def flush():
        cuts = np.cumsum([0] + [len(t) for _, t, _ in held])
        target = np.concatenate([t for _, t, _ in held])
        values = log_probabilities(p, target, np.concatenate([c for _, _, c in held], axis=1))
        if spread is not None:
            values += spread[target]
        for (k, _, _), a, b in zip(held, cuts, cuts[1:]):
            total[k] += float(values[a:b].sum())

    for own in found:
        seq = word_buckets(own)
        context = windows(seq)
        size.append(len(seq))
        total.append(0.0)
        for i in range(0, len(seq), TOGETHER):
            held.append((len(size) - 1, seq[i:i + TOGETHER], context[:, i:i + TOGETHER]))
            n += len(held[-1][1])
            if n >= TOGETHER:
                flush()
                held, n = [], 0
    if held:
        flush()
    return list(zip(size, total))


def _score(flat):
    def run(batches):
        import pyarrow as pa

        p = unpack(flat)
        for b in batches:
            made = scores(p, [words(t.as_py()) for t in b.column("text")])
            n, score = [x[0] for x in made], [x[1] for x in made]
            mean = [s / k if k else None for s, k in zip(score, n)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(score, pa.float64()), pa.array(mean, pa.float64())],
                                             names=["doc_id", "n_tokens", "score", "mean_score"])
    return run


def units(n: int) -> int:
    """The log of a count in units."""
    return round(math.log(n) * UNIT)


def _score_words(flat, spread, held, joined):
    """Rows with the part of the score that a task knows, and the words whose
    counts are to be joined (``joined``: there are any)."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        p, task, row = unpack(flat), TaskContext.get().partitionId(), 0
        for b in batches:
            found = [words(t.as_py()) for t in b.column("text")]
            made, known, rest, times = scores(p, found, spread), [], [], []
            for own in found:
                total, other = 0, {}
                for w, n in Counter(own).items():
                    k = w if len(w) <= SHORT else word_key(w)
                    value = held.get(k)
                    if value is not None:
                        total += n * value
                    elif joined:
                        other[k] = n
                known.append(total)
                rest.append(list(other))
                times.append(list(other.values()))
            k = len(found)
            yield pa.RecordBatch.from_arrays([pa.array([task] * k, pa.int32()), pa.array(range(row, row + k), pa.int64()), b.column("doc_id"),
                                              pa.array([x[0] for x in made], pa.int64()), pa.array([x[1] for x in made], pa.float64()), pa.array(known, pa.int64()),
                                              pa.array(rest, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                                             names=["task", "row", "doc_id", "n_tokens", "network", "known", "words", "times"])
            row += k
    return run


def score(docs: DataFrame, flat, counts: DataFrame | None = None, most: int = HELD) -> DataFrame:
    """doc_id, n_tokens, score (summed log-probabilities) and its mean.
    ``counts`` are those of ``count_words``, of which a task holds ``most``;
    without them the score is that of the buckets alone."""
    import numpy as np

    bounded_batches(docs.sparkSession)
    texts = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    if counts is None:
        return texts.mapInArrow(_score(flat), "doc_id long, n_tokens long, score double, mean_score double")
    spread = np.zeros(VOCAB)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        spread[r.bucket] = -math.log(r.n + 1)
    level = F.floor(F.log("n") * 8)  # 0 for words counted once, whose log is 0
    size = {r.level: r.n for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, n = max(size, default=0) + 1, 0
    for x in sorted(size, reverse=True):
        n += size[x]
        if x == 0 or n > most:
            break
        least = x
    held = {bytes(r.word): units(r.n) for r in counts.filter(level >= least).select("word", "n").collect()}  # ``most`` rows at most
    joined = any(0 < x < least for x in size)
    made = staged(texts.mapInArrow(_score_words(flat, spread, held, joined), "task int, row long, doc_id long, n_tokens long, network double, "
                                   "known long, words array<binary>, times array<long>"), "lm-scored")
    total = F.col("known")
    rows = made.select("task", "row", "doc_id", "n_tokens", "network", "known")
    if joined:
        rare = counts.filter((level > 0) & (level < least)).select("word", F.round(F.log("n") * UNIT).cast("long").alias("value"))
        pairs = made.select("task", "row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("task", "row", "x.words", "x.times")
        more = pairs.join(rare, pairs["words"] == rare["word"]).groupBy("task", "row").agg(F.sum(F.col("times") * F.col("value")).alias("more"))
        rows = rows.join(more, ["task", "row"], "left")
        total = total + F.coalesce("more", F.lit(0))
    out = rows.select("doc_id", "n_tokens", (F.col("network") + total / F.lit(float(UNIT))).alias("score"))
    return out.withColumn("mean_score", F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")))
