"""URL filters as a sort-merge range join.

A host is reversed label by label (``blog.example.org`` -> ``org.example.blog.``),
so that "the host and all its subdomains" is one interval of keys: all keys
that begin with the rule's. URLs are range-partitioned and sorted on
``(reversed host, path, id)``, so a host that holds a third of all rows is
spread over tasks, and each task sweeps its sorted run once. The sweep keeps
a stack of the nested host intervals that contain the current key; every
entry carries the path prefixes of its host, found by length; the longest rule
among the active entries that fits the path wins (of equally long ones the longer
host, then ``block``).

Rules are a configuration list that the driver holds. A task is sent at most
``BLOCK`` rules: with more, block after block is swept in a job of its own,
over rows staged with their best rule so far.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and gets the default verdict. A path that is empty does not
begin with ``/``. Repeated rows each give a row, a null id is passed through,
an empty table gives an empty result; columns but the id and url are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, staged

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 100_000

#: Fixed rules of the registered query: (verdict, host, path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def reversed_host(name: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(name, r"\.", -1)), "."), F.lit("."))


def reversed_key(name: str) -> str:
    return ".".join(reversed(name.split("."))) + "."


class Paths:
    """The path prefixes of one host: the longest that begins a path is looked
    up by its lengths, so many prefixes cost no more than their lengths."""

    def __init__(self, rules):
        self.rules = {}
        for verdict, name, prefix in rules:
            if self.rules.get(prefix, ("allow",))[0] != "block":
                self.rules[prefix] = (verdict, name + prefix)
        self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def longest(self, path: str):
        for n in self.lengths:
            if n <= len(path) and (hit := self.rules.get(path[:n])):
                return hit
        return None


def build(rules):
    """Host intervals in key order: (key, path prefixes of that host)."""
    by_host: dict[str, list] = {}
    for verdict, name, prefix in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        by_host.setdefault(reversed_key(name.lower()), []).append((verdict, name.lower(), prefix))
    return [(k, Paths(v)) for k, v in sorted(by_host.items())]


def sweeper(intervals):
    """A function (key, path) -> (verdict, rule, labels of its host) of the
    best rule, for keys in ascending order."""
    keys = [k for k, _ in intervals]
    stack: list[int] = []
    at = [None]

    def enter(key: str) -> None:
        if at[0] is None:  # the run may begin inside intervals opened before it
            at[0] = 0
            for end in (i + 1 for i, c in enumerate(key) if c == "."):
                i = bisect_left(keys, key[:end])
                if i < len(keys) and keys[i] == key[:end]:
                    stack.append(i)
            at[0] = bisect_left(keys, key + "\0")
            return
        while stack and not key.startswith(keys[stack[-1]]):
            stack.pop()
        while at[0] < len(keys) and keys[at[0]] <= key:
            if key.startswith(keys[at[0]]):
                stack.append(at[0])
            at[0] += 1

    last, found = [None, None], [None]

    def best(key: str, path: str):
        if last == [key, path]:
            return found[0]
        if last[0] != key:
            enter(key)
        last[:] = key, path
        top = None
        for i in reversed(stack):
            hit = intervals[i][1].longest(path)
            if hit and (top is None or len(hit[1]) > len(top[1])):
                top = (*hit, intervals[i][0].count("."))
        found[0] = top
        return top

    return best


_FOUND = "page_id long, host string, path string, rkey string, rule string, verdict string, labels int"


def _sweep(intervals):
    """The best rule so far, or a better one of this block."""
    def run(batches):
        import pyarrow as pa

        best = sweeper(intervals)
        for b in batches:
            found = []
            for k, p, rule, verdict, labels in zip(*(b.column(c).to_pylist() for c in ("rkey", "path", "rule", "verdict", "labels"))):
                hit = best(k, p)
                if hit and (rule is None or (len(hit[1]), hit[2]) > (len(rule), labels)):
                    verdict, rule, labels = hit
                found.append((rule, verdict, labels))
            rule, verdict, labels = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("page_id", "host", "path", "rkey")), pa.array(rule, pa.string()), pa.array(verdict, pa.string()),
                 pa.array(labels, pa.int32())], names=["page_id", "host", "path", "rkey", "rule", "verdict", "labels"])
    return run


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", block: int = BLOCK) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages``."""
    bounded_batches(pages.sparkSession, 4096)
    rules = sorted(rules, key=lambda r: reversed_key(r[1].lower()))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host(F.col(url_col)).alias("host"),
                        path(F.col(url_col)).alias("path"))
    none = F.lit(None)
    rows = rows.select("*", reversed_host(F.col("host")).alias("rkey"), none.cast("string").alias("rule"), none.cast("string").alias("verdict"),
                       none.cast("int").alias("labels"))
    order = ["rkey", "path", "page_id"]
    for i in range(0, max(1, len(rules)), block):
        if i:
            rows = staged(rows, "url-rules")  # a job of its own, so that a task is sent one block of rules
        run = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = run.mapInArrow(_sweep(build(rules[i:i + block])), _FOUND)
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
