"""Exact dedup: the state, collisions of the digest, and the edge cases."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as E


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for g in groups.values():
        ids = [i for i in g if i is not None]
        keep = max(ids) if ids else None
        out += [(str(i), str(keep), len(g), i == keep) for i in g]
    return sorted(out)


def got(df, **kw):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in E.dedup(df, **kw).collect())


ROWS = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, "x" * 200000), (9, "x" * 200000), (9, "x" * 200000),
        (None, "b"), (None, "n"), (10, "c")] + [(20 + i, "hot") for i in range(50)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, keep_id string, digest int")


def test_state_over_several_batches(spark):
    assert got(frame(spark, ROWS).repartition(7), batches=4) == want(ROWS)
    assert got(frame(spark, []).limit(0)) == []


def test_colliding_digests_are_told_apart_by_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    weak = lambda t: F.substring(E.sha256(t), 1, 1)
    rows = [tuple(r) for r in docs.collect()]
    assert got(docs, digest=weak) == want(rows) == got(docs)


def test_keep_one(spark):
    df = frame(spark, ROWS)
    out = E.keep_one(df)
    assert out.columns == df.columns
    left = sorted(str(r.doc_id) for r in out.collect())
    assert left == sorted(i for i, _, _, k in want(ROWS) if k)


def test_a_later_delivery_is_judged_by_the_state_of_the_first(spark, tmp_path):
    state = str(tmp_path / "state")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    seen = lambda df: {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()}
    first, second = frame([(1, "a"), (2, "a"), (3, "b")]), frame([(4, "a"), (5, "c"), (0, "b")])
    assert seen(E.dedup(first, state_dir=state, delivery="one")) == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)}
    want = {(4, 4, 3, True), (5, 5, 1, True), (0, 3, 2, False)}
    assert seen(E.dedup(second, state_dir=state, delivery="two", earlier=first)) == want
    assert seen(E.dedup(second, state_dir=state, delivery="two")) == want  # again, as after a failure
    with pytest.raises(ValueError):
        E.dedup(first, state_dir=state)


def test_colliding_digests_of_two_deliveries_are_told_apart(spark, tmp_path):
    weak = lambda t: F.unhex(F.when(t.isNull(), F.lit("ABCDEF")).otherwise(F.lit("ABCDEF")))  # noqa: E731 - one digest for all
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first, state = frame([(1, "a"), (2, "b")]), str(tmp_path / "state")
    E.dedup(first, weak, state_dir=state, delivery="one").count()
    out = E.dedup(frame([(3, "a"), (4, "c")]), weak, state_dir=state, delivery="two", earlier=first)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()} == {(3, 3, 2, True), (4, 4, 1, True)}


def test_keep_one_of_an_empty_table(spark):
    assert E.keep_one(spark.createDataFrame([], "doc_id long, text string, digest int")).collect() == []
