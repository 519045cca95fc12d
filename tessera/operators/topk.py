"""Top-k family of operators.

Every operator takes column names / sort expressions as arguments so it
works on any table. Orders should be total (add tie-break columns) when the
result must be reproducible.

Scale notes
-----------
* ``top_k`` -> ``TakeOrderedAndProject``: each task keeps k rows, the driver
  merges k x tasks rows. k is the report size, never data dependent.
* ``top_n_per_group`` -> a rank/row_number filter, which Catalyst plans as
  WindowGroupLimit (partial, before the shuffle) + WindowGroupLimit (final).
  A group holding a third of all rows therefore ships at most n rows (plus
  ties) per map task to its window task.
* ``top_n_with_ties`` / ``group_max_ties`` -> rank <= n with ties as a
  threshold join: per group the n-th value (bounded limit, or min/max) and
  a join of every row to its group's threshold. No task holds more than n
  rows of a group however many rows tie, and the one-row-per-group side is
  small enough for AQE to broadcast.
* ``arg_min`` / ``latest_by_key`` -> ``min``/``max_by`` over a struct: an
  aggregate with a map-side partial step (sort-based when the carried row
  holds strings), no window at all, so a hot key is reduced per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """SRT-3: global top-k by ``order``."""
    return df.orderBy(*_cols(order)).limit(k)


def top_n_per_group(df: DataFrame, group: Sequence, order: Sequence, n: int,
                    ties: bool = False, rank_col: str | None = None,
                    strict: bool = False) -> DataFrame:
    """WIN-1/WIN-3 + FLT-11: the first ``n`` rows of each group.

    ``ties=False`` uses ``row_number`` (exactly n rows, WIN-3); ``ties=True``
    uses ``rank`` (all rows whose rank is <= n, WIN-1). ``strict=True`` keeps
    rank < n instead of <= n. ``rank_col`` keeps the rank as a column.
    """
    w = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rank"
    out = df.withColumn(name, fn.over(w))
    out = out.filter(F.col(name) < n) if strict else out.filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def group_max_ties(df: DataFrame, group: Sequence, value: str) -> DataFrame:
    """WIN-2 + FLT-10: every row equal to its group's maximum ``value``.

    Same rows as ``value = max(value) over (partition by group)``, computed
    as a max aggregate (partial before the shuffle) joined back on the group
    key, so no task ever holds a whole group (see ``top_n_with_ties``).
    """
    return top_n_with_ties(df, list(group), value, 1, descending=True)


def arg_min(df: DataFrame, group: Sequence, order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """AGG-8: per group, the row with the smallest ``order`` tuple (ties
    broken by the following order columns and then ``carry``)."""
    group = list(group)
    fields = list(order) + [c for c in carry if c not in order]
    best = F.min(F.struct(*[F.col(c) for c in fields])).alias("__best")
    return df.groupBy(*group).agg(best).select(*group, *[F.col(f"__best.{c}").alias(c) for c in fields])


def kth_smallest(df: DataFrame, group: Sequence, value: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """AGG-13: per group the k-th smallest ``value``, or the largest when the
    group has fewer than k rows. Output ``(group..., threshold)``."""
    group = list(group)
    order = [F.col(value).asc()] + [F.col(c).asc() for c in tie]
    firsts = top_n_per_group(df.select(*group, value, *tie), group, order, k)
    return firsts.groupBy(*group).agg(F.max(value).alias("threshold"))


def threshold_join(df: DataFrame, thresholds: DataFrame, group: Sequence[str], value: str,
                   low: int = 1) -> DataFrame:
    """JN-8 + FLT-6: rows whose ``value`` lies in ``[low, threshold]`` of
    their group. ``thresholds`` has one row per group; no broadcast hint:
    the number of groups is not bounded in general, so AQE decides from the
    measured size of the threshold stage (broadcast when it is small).
    """
    t = thresholds.select(*group, "threshold")
    return (df.join(t, list(group), "inner")
              .filter(F.col(value).between(F.lit(low), F.col("threshold")))
              .drop("threshold"))


def nth_value(df: DataFrame, group: Sequence[str], value: str, n: int, descending: bool = False) -> DataFrame:
    """Per group the n-th smallest (largest when ``descending``) non-NULL
    ``value``, duplicates counted, or the last one when the group has fewer
    than n values. Output ``(group..., threshold)``.

    n = 1 is a plain min / max aggregate; otherwise a row_number <= n filter
    (partial group limit before the shuffle) and a max / min over at most n
    rows per group.
    """
    group = list(group)
    vals = df.select(*group, value).filter(F.col(value).isNotNull())
    if n == 1:
        agg = F.max(value) if descending else F.min(value)
        return vals.groupBy(*group).agg(agg.alias("threshold"))
    order = [F.col(value).desc()] if descending else [F.col(value).asc()]
    firsts = top_n_per_group(vals, group, order, n)
    agg = F.min(value) if descending else F.max(value)
    return firsts.groupBy(*group).agg(agg.alias("threshold"))


def top_n_with_ties(df: DataFrame, group: Sequence[str], value: str, n: int,
                    descending: bool = False, strict: bool = False) -> DataFrame:
    """Rows whose ``rank()`` by ``value`` inside their group is <= n (< n with
    ``strict``), ties included; rows with a NULL ``value`` never qualify.

    rank(x) <= n exactly when fewer than n values are better than x, i.e.
    when x is at least as good as the group's n-th value (duplicates
    counted). So the rows are found by joining each row to its group's
    threshold (one row per group) and comparing, instead of ranking whole
    groups in one window task. However many rows tie, no task holds more
    than n rows of a group. The input is computed once (the two branches
    share one exchange, ``ReusedExchange`` in the final plan), and once the
    threshold stage has run AQE turns the join into a broadcast hash join
    when that side is small (a runtime size check, sort-merge otherwise);
    the big side's shuffle is then read locally, so a hot group does not
    land in one reduce task.
    """
    if not group:
        raise ValueError("top_n_with_ties needs group columns (a global top-n is top_k)")
    k = n - 1 if strict else n
    if k < 1:
        return df.limit(0)
    thr = nth_value(df, group, value, k, descending)
    keep = F.col(value) >= F.col("threshold") if descending else F.col(value) <= F.col("threshold")
    return df.join(thr, list(group), "inner").filter(keep).drop("threshold")


def slice_by_rank(df: DataFrame, score: str, member: str, start: int, stop: int,
                  descending: bool = True) -> DataFrame:
    """SRT-6: sorted-set range ``[start, stop]`` (0-based, both ends
    inclusive) ordered by ``score`` then ``member``, with its position.

    ``orderBy.limit(stop + 1).offset(start)`` is a bounded TakeOrderedAndProject;
    no global window, no full sort.
    """
    if start < 0 or stop < start:
        raise ValueError("need 0 <= start <= stop")
    s = F.col(score).desc() if descending else F.col(score).asc()
    m = F.col(member).desc() if descending else F.col(member).asc()
    picked = df.select(member, score).orderBy(s, m).limit(stop + 1).offset(start)
    # The window only sees the (stop - start + 1) picked rows.
    pos = F.row_number().over(Window.orderBy(s, m)) + F.lit(start - 1)
    return picked.withColumn("position", pos.cast("int"))


def any_rows(df: DataFrame, n: int) -> DataFrame:
    """SRT-9: an arbitrary sample of n rows (limit without order)."""
    return df.limit(n)


def top_n_lists(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
                fields: Sequence[str]) -> DataFrame:
    """AGG-9: per group an array of the first ``n`` rows (as structs of
    ``fields``, in ``order``). The per-group limit runs first (partial limit
    before the shuffle), so ``collect_list`` never sees more than ``n`` rows
    of a group, however large the group is."""
    group = list(group)
    kept = top_n_per_group(df, group, order, n, rank_col="__pos")
    items = F.sort_array(F.collect_list(F.struct(F.col("__pos"), *[F.col(f) for f in fields])))
    return kept.groupBy(*group).agg(
        F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("items"))
