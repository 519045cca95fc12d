"""Positions in a whole order, and slices of it, without a single task that
sees every row (SRT-5, SRT-6, SRT-10).

``with_position`` sorts by range partitions and numbers the rows of each
range where they lie; the ranges' row counts (one number per range) are added
up and joined back, so a row's position is its range's offset plus its place
in the range. Rows that tie on the whole order are dealt out by a hash of
their columns, so only rows equal in every column share a range.

``kth_by_counts`` finds the k-th smallest value of every group by narrowing
value ranges on counts, so what is shuffled doesn't depend on k.

``rank_slice`` selects order statistics: splitters from a bounded sample cut
the candidates into ranges, one count per range tells which ranges hold the
wanted positions, and only those are kept for the next round. The rows before
the slice are counted, never sorted or moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tessera.session import scratch_dir

#: monotonically_increasing_id() keeps a row's place in its partition in the
#: low bits and the partition's number above them.
PLACE_BITS = 33


def _free(df: DataFrame, wish: str) -> str:
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def _hashable(t: DataType) -> bool:
    if isinstance(t, ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return not isinstance(t, (MapType, VariantType))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def offsets(counts: Sequence[int]) -> list[int]:
    """Rows before each range, for the row counts of the ranges in order."""
    return list(accumulate(counts, initial=0))[:-1]


def with_position(df: DataFrame, order: Sequence, position: str = "position", start: int = 1) -> DataFrame:
    """``df`` with each row's position (BIGINT, from ``start``) in ``order``
    over all rows. Rows that tie on ``order`` are ordered by a hash of all
    their columns, the same in every run.

    The sorted ranges are written once to the shared scratch folder, so that
    counting and numbering see the same ranges and a lost executor costs a
    reread. The driver handles one count per range. An empty ``df`` gives an
    empty result; a ``position`` column of ``df`` is not overwritten but
    refused.
    """
    if position.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"{position!r} is a column already")
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    at, part, before = (_free(df, n) for n in ("at", "part", "before"))
    run = df.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    stored = _stored(run.withColumn(at, F.monotonically_increasing_id()), "ordered")
    number = F.shiftright(F.col(at), PLACE_BITS)
    counts = sorted((r[0], r[1]) for r in stored.groupBy(number.alias(part)).agg(F.count(F.lit(1))).collect())
    rows = list(zip((p for p, _ in counts), offsets([n for _, n in counts])))
    first = spark.createDataFrame(rows, f"`{part}` long, `{before}` long")
    place = F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (stored.join(first, number == first[part])
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col(before) + place + F.lit(start)).alias(position)))


def _sorts_before(score: Column, member: Column, at: tuple, descending: bool) -> Column:
    s, m = F.lit(at[0]), F.lit(at[1])
    nearer = (lambda a, b: a > b) if descending else (lambda a, b: a < b)
    return nearer(score, s) | ((score == s) & nearer(member, m))


def _range_of(score: Column, member: Column, splitters: list[tuple], descending: bool) -> Column:
    """The number of splitters that sort at or before the row: a binary
    search written as nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(_sorts_before(score, member, splitters[mid], descending), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(splitters))


def _splitters(rows: DataFrame, score: str, member: str, descending: bool, pieces: int, per_piece: int = 32) -> list[tuple]:
    """At most ``pieces - 1`` distinct (score, member) pairs in order, evenly
    spaced in the ``pieces * per_piece`` rows whose hashes are least."""
    sample = (rows.select(score, member).orderBy(F.xxhash64(member, score), score, member).limit(pieces * per_piece).collect())
    keys = sorted({(r[0], r[1]) for r in sample}, reverse=descending)
    step = max(1, len(keys) // pieces)
    return keys[step::step][:pieces - 1]


def rank_slice(df: DataFrame, score: str, member: str, start: int, stop: int, descending: bool = True,
               pieces: int = 64, enough: int = 100_000) -> DataFrame:
    """SRT-6: the rows at positions ``start`` to ``stop`` (from 0, both
    included, as in a sorted set) of the order by ``score`` then ``member``,
    with their ``position``; in descending order both are turned round.

    Works at any depth: every round narrows the candidates about ``pieces``
    times, until at most ``enough`` rows (or four times the slice) are left;
    only these are sorted, by ranges. Rows with a null score or member are no
    entries of the ranking. Equal (score, member) rows each take a position.
    A slice beyond the last row is empty.
    """
    if start < 0 or stop < start:
        raise ValueError("need 0 <= start <= stop")
    rows = _stored(df.select(member, score).filter(F.col(score).isNotNull() & F.col(member).isNotNull()), "ranked")
    s, m = F.col(score), F.col(member)
    before, n = 0, rows.count()
    while n > max(enough, 4 * (stop - start + 1)) and before + n > start:
        splitters = _splitters(rows, score, member, descending, pieces)
        counts = dict(rows.groupBy(_range_of(s, m, splitters, descending).alias("range")).agg(F.count(F.lit(1))).collect())
        sizes = [counts.get(i, 0) for i in range(len(splitters) + 1)]
        firsts = [before + o for o in offsets(sizes)]
        held = [i for i, (f, k) in enumerate(zip(firsts, sizes)) if k and f <= stop and f + k > start]
        left = sum(sizes[i] for i in held)
        if left == n:  # one key holds them all
            break
        before, n = (firsts[held[0]], left) if held else (before + n, 0)
        kept = _range_of(s, m, splitters, descending).between(*((held[0], held[-1]) if held else (-1, -1)))
        rows = _stored(rows.filter(kept), "ranked")
    order = [s.desc(), m.desc()] if descending else [s.asc(), m.asc()]
    return with_position(rows, order, start=before).filter(F.col("position").between(start, stop))


def kth_by_counts(df: DataFrame, group: Sequence[str], value: str, k: int, ranges: int = 256) -> DataFrame:
    """AGG-13 for any k: per group the k-th smallest value of the integer
    column ``value`` (duplicates counted, nulls not), or the largest when the
    group has fewer than k. Output ``(group..., threshold)``; groups are
    compared as by GROUP BY, so null is a group.

    Every round counts each group's values in ``ranges`` equal parts of the
    interval that holds its k-th (at most so many rows a group and task reach
    the shuffle) and narrows the interval to one part, until it is one value:
    8 bits of the value range a round, whatever k is. Values must span less
    than 2^63.
    """
    if k < 1:
        raise ValueError("need k >= 1")
    group = list(group)
    keys = [f"key{i}" for i in range(len(group))]
    vals = _stored(df.select(*[F.col(g).alias(n) for g, n in zip(group, keys)], F.col(value).cast("long").alias("v"))
                   .filter("v IS NOT NULL"), "kth")
    # want: the place of the k-th value among those in [lo, hi]
    held = _stored(vals.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.least(F.count(F.lit(1)), F.lit(k)).alias("want")), "kth-held")
    while not held.filter("lo < hi").isEmpty():
        open_ = held.filter("lo < hi").select(*[F.col(n).alias(f"of_{n}") for n in keys], "lo", "hi", "want")
        same = F.lit(True)
        for n in keys:
            same = same & vals[n].eqNullSafe(open_[f"of_{n}"])
        width = F.call_function("div", F.col("hi") - F.col("lo"), F.lit(ranges).cast("long")) + 1
        inside = vals.join(open_, same & (vals["v"] >= open_["lo"]) & (vals["v"] <= open_["hi"]))
        counts = (inside.groupBy(*keys, "lo", "hi", "want", F.call_function("div", F.col("v") - F.col("lo"), width).alias("part"))
                  .agg(F.count(F.lit(1)).alias("n")))
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("part"))  # at most `ranges` rows a group
        found = counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
        lo = F.col("lo") + F.col("part") * width
        narrowed = found.select(*keys, lo.alias("lo"), F.least(F.col("hi"), lo + width - 1).alias("hi"),
                                (F.col("want") - F.col("upto") + F.col("n")).alias("want"))
        held = _stored(held.filter("lo = hi").unionByName(narrowed), "kth-held")
    return held.select(*[F.col(n).alias(g) for n, g in zip(keys, group)], F.col("lo").cast(df.schema[value].dataType).alias("threshold"))
