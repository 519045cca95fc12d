"""Positions over whole results, deep slices and reports (SRT-5, 6, 10)."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.ordering import _range_of, kth_by_counts, rank_slice, with_position
from tessera.sinks.reports import read_report, write_report


def _rows(n=3000, seed=1):
    rng = random.Random(seed)
    return [(f"m{rng.randrange(10**6):06d}-{i}", rng.randrange(40)) for i in range(n)]


def test_positions_follow_the_whole_order(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "member string, score long").repartition(7)
    got = {r.member: r.position for r in with_position(df, [F.col("score").desc(), "member"]).collect()}
    want = {m: i + 1 for i, (m, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want


def test_positions_of_ties_duplicates_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, None), ("b", 1)], "member string, score long")
    got = with_position(df, ["score"], start=0).collect()
    assert sorted(r.position for r in got) == [0, 1, 2, 3]
    assert next(r.position for r in got if r.score is None) == 0
    assert with_position(df.limit(0), ["score"]).count() == 0
    with pytest.raises(ValueError):
        with_position(df, ["score"], position="Member")


def test_positions_where_every_row_ties_use_many_ranges(spark):
    df = spark.range(20_000).select(F.lit(1).alias("score"), F.col("id").alias("at"), F.lit(2).alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_position(df, ["score"], position="n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.columns == ["score", "at", "part", "n"]
    assert out.agg(F.sum("n")).first()[0] == 20_000 * 20_001 // 2
    files = out.inputFiles()
    assert len(files) > 4  # rows tied on the order are still dealt over ranges


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("start,stop", [(0, 0), (0, 10), (1495, 1505), (2990, 3100), (5000, 5001)])
def test_deep_slice_equals_sorted_rows(spark, descending, start, stop):
    rows = _rows()
    df = spark.createDataFrame(rows, "member string, score long").repartition(5)
    got = [tuple(r) for r in rank_slice(df, "score", "member", start, stop, descending, pieces=8, enough=50).orderBy("position").collect()]
    order = sorted(((s, m) for m, s in rows), reverse=descending)
    assert got == [(m, s, i) for i, (s, m) in enumerate(order)][start:stop + 1]


def test_deep_slice_of_equal_rows_nulls_and_nothing(spark):
    same = spark.createDataFrame([("x", 1.0)] * 400 + [("y", 2.0)] * 400 + [("z", None), (None, 3.0)], "member string, score double")
    got = rank_slice(same, "score", "member", 395, 404, pieces=4, enough=10).orderBy("position").collect()
    assert [r.member for r in got] == ["y"] * 5 + ["x"] * 5
    assert [r.position for r in got] == list(range(395, 405))
    assert rank_slice(same.limit(0), "score", "member", 0, 3).count() == 0
    with pytest.raises(ValueError):
        rank_slice(same, "score", "member", 3, 2)


def test_deep_slice_sorts_no_rows_before_it(spark):
    df = spark.createDataFrame(_rows(), "member string, score long")
    out = rank_slice(df, "score", "member", 1500, 1505, pieces=8, enough=100)
    out.collect()
    assert "TakeOrdered" not in out._jdf.queryExecution().executedPlan().toString()
    # what is sorted last: the ranges that hold the slice, not the 1500 rows before it
    assert spark.read.parquet(*out.inputFiles()).count() <= 400


def test_range_of_counts_splitters_before_a_row(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("a", 9), ("a", 1)], "member string, score long")
    cuts = [(9, "a"), (5, "b")]
    got = {(r.member, r.score): r.n for r in df.select("*", _range_of(F.col("score"), F.col("member"), cuts, True).alias("n")).collect()}
    assert got == {("a", 9): 1, ("c", 5): 1, ("b", 5): 2, ("a", 5): 2, ("a", 1): 2}


def test_report_lines_are_numbered_over_all_files(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit('a,"b').alias("s"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    path = str(tmp_path / "report")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
        write_report(df, path, ["v"])
        rows = read_report(spark, path, "v long, s string").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "report").glob("part-*"))) > 4
    assert sorted((r.position, r.v) for r in rows) == [(i + 1, i) for i in range(5000)]
    assert {r.s for r in rows} == {'a,"b'}


def test_a_shuffled_report_shows(spark, tmp_path):
    path = str(tmp_path / "shuffled")
    spark.range(500).repartition(4, "id").write.csv(path)
    rows = read_report(spark, path, "v long").collect()
    assert sorted(r.position for r in rows) == list(range(1, 501))
    assert any(r.position != r.v + 1 for r in rows)


def test_empty_report(spark, tmp_path):
    path = str(tmp_path / "empty")
    write_report(spark.range(0), path, ["id"])
    assert read_report(spark, path, "v long").collect() == []


@pytest.mark.parametrize("k", [1, 7, 100, 10_000])
@pytest.mark.parametrize("ranges", [2, 256])
def test_kth_by_counts_equals_sorted_values(spark, k, ranges):
    rng = random.Random(k)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randrange(-5, 5), rng.randrange(10**12), 3, None])) for _ in range(900)]
    rows += [("one", 2**61)] + [("same", 5)] * 300 + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(4)
    got = {r.g: r.threshold for r in kth_by_counts(df, ["g"], "v", k, ranges=ranges if k == 7 else 256).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        vals = sorted(v for h, v in rows if h == g and v is not None)
        if vals:
            want[g] = vals[min(k, len(vals)) - 1]
    assert got == want


def test_kth_by_counts_of_several_keys_and_nothing(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "x", 4), (1, "y", 9)], "key0 int, h string, v int")
    out = kth_by_counts(df, ["key0", "h"], "v", 2)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 5), (1, "y", 9)]
    assert dict(out.dtypes) == {"key0": "int", "h": "string", "threshold": "int"}
    assert kth_by_counts(df.limit(0), ["h"], "v", 2).collect() == []
    with pytest.raises(ValueError):
        kth_by_counts(df, ["h"], "v", 0)


def test_kth_by_counts_shuffles_as_many_rows_for_any_k(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 19_997).alias("v"))
    plan = kth_by_counts(df, ["g"], "v", 5000)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # what is left is one row a group, already written
