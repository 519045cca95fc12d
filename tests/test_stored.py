"""Stored tables under updates: partials, keyed tables, corrected counters."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.sinks import keyed_table, partials, store
from tessera.sources.records import RECORD_SEPARATOR
from tessera.streaming import corrections as X

KEYS, SUMS = ["k"], ["n", "m"]


def _sums(spark, rows):
    return spark.createDataFrame(rows, "k string, n long, m long")


def _table(df):
    return sorted((r.k, r.n, r.m) for r in df.collect())


def test_batches_add_up_and_a_replay_does_not_count_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    partials.add_batch(_sums(spark, [("a", 1, 10), ("b", 2, 20)]), path, 0)
    partials.add_batch(_sums(spark, [("a", 5, 50)]), path, 1)
    partials.add_batch(_sums(spark, [("a", 5, 50)]), path, 1)
    assert _table(partials.merged(spark, path, KEYS, SUMS)) == [("a", 6, 60), ("b", 2, 20)]
    assert partials.compact(spark, path, KEYS, SUMS, ["k"]) == 1
    partials.add_batch(_sums(spark, [("b", -2, -20), (None, 1, 1)]), path, 7)
    want = [("a", 6, 60), (None, 1, 1)]
    assert sorted(_table(partials.merged(spark, path, KEYS, SUMS).fillna("~", "k"))) == sorted([("a", 6, 60), ("~", 1, 1)])
    assert partials.compact(spark, path, KEYS, SUMS, ["k"]) == 7
    assert partials.compact(spark, path, KEYS, SUMS, ["k"]) == 7  # nothing new
    partials.prune(spark, path)
    assert store.children(spark, f"{path}/batches") == [] and store.children(spark, f"{path}/base") == ["through=7"]
    assert {tuple(r) for r in partials.merged(spark, path, KEYS, SUMS).collect()} == set(want)
    with pytest.raises(ValueError):
        partials.add_batch(_sums(spark, []), path, 7)


def test_a_base_left_by_a_failed_job_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    partials.add_batch(_sums(spark, [("a", 1, 1)]), path, 0)
    partials.compact(spark, path, KEYS, SUMS, ["k"])
    partials.add_batch(_sums(spark, [("a", 1, 1)]), path, 1)
    _sums(spark, [("a", 99, 99)]).write.parquet(f"{path}/base/through=1")
    os.remove(f"{path}/base/through=1/_SUCCESS")
    assert _table(partials.merged(spark, path, KEYS, SUMS)) == [("a", 2, 2)]
    assert partials.compact(spark, path, KEYS, SUMS, ["k"]) == 1  # written anew
    assert _table(partials.merged(spark, path, KEYS, SUMS)) == [("a", 2, 2)]


def test_no_batch_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        partials.merged(spark, path, KEYS, SUMS)
    partials.add_batch(_sums(spark, []), path, 0)
    assert _table(partials.merged(spark, path, KEYS, SUMS)) == []


def test_compacted_base_is_in_answer_order(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(3)
    for b in range(3):
        partials.add_batch(_sums(spark, [(f"k{rng.randrange(50):02d}", rng.randrange(9), 1) for _ in range(100)]).groupBy("k").agg(
            F.sum("n").alias("n"), F.sum("m").alias("m")), path, b)
    partials.compact(spark, path, KEYS, SUMS, ["k"])
    folder = f"{path}/base/through=2"
    keys = [r.k for f in sorted(os.listdir(folder)) if f.startswith("part-") for r in spark.read.parquet(f"{folder}/{f}").coalesce(1).collect()]
    assert keys == sorted(keys) and len(keys) == len(set(keys))


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, seq long")


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_upsert_rewrites_only_the_folders_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(_rows(spark, [(i, "old", 1) for i in range(400)]), path, ["k"], "seq", 16)
    before = _files(path)
    touched = keyed_table.upsert(_rows(spark, [(7, "new", 2), (1000, "new", 2), (8, "late", 0)]), path, ["k"], "seq", 16)
    after = _files(path)
    assert 1 <= len(touched) <= 3
    folders = {f"bucket={b}" for b in touched}
    assert {f for f in before if f.split(os.sep)[-2] not in folders} == {f for f in after if f.split(os.sep)[-2] not in folders}
    assert not {f for f in before & after if f.split(os.sep)[-2] in folders}
    got = {r.k: r.v for r in keyed_table.read(spark, path).collect()}
    assert got == {i: "new" if i in (7, 1000) else "old" for i in [*range(400), 1000]}
    assert keyed_table.read(spark, path).columns == ["k", "v", "seq"]


def test_upserts_equal_last_write_wins_over_all_rows(spark, tmp_path):
    path, rng = str(tmp_path / "t"), random.Random(5)
    rows = [(rng.choice([None, *range(30)]), f"v{i}", i) for i in range(300)]
    keyed_table.create(_rows(spark, rows[:100]), path, ["k"], "seq", 4)
    for a, b in ((200, 300), (100, 200), (200, 300)):
        keyed_table.upsert(_rows(spark, rows[a:b]).select("seq", "v", "k"), path, ["k"], "seq", 4)
    want = {}
    for k, v, s in rows:
        want[k] = (v, s)
    assert {r.k: (r.v, r.seq) for r in keyed_table.read(spark, path).collect()} == want
    assert keyed_table.upsert(_rows(spark, []), path, ["k"], "seq", 4) == []


def test_an_update_that_died_is_finished_or_forgotten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed_table.create(_rows(spark, [(i, "old", 1) for i in range(50)]), path, ["k"], "seq", 4)
    write, calls = keyed_table._write, []

    def dies(rows, to, key, dynamic=False):
        calls.append(to)
        if dynamic:
            raise RuntimeError("lost driver")
        write(rows, to, key, dynamic)

    monkeypatch.setattr(keyed_table, "_write", dies)
    with pytest.raises(RuntimeError):
        keyed_table.upsert(_rows(spark, [(3, "new", 2)]), path, ["k"], "seq", 4)
    monkeypatch.setattr(keyed_table, "_write", write)
    read = lambda: {r.k: r.v for r in keyed_table.read(spark, path).collect()}
    assert read()[3] == "old"  # still whole and readable
    assert keyed_table.recover(spark, path, ["k"]) is True
    assert read() == {i: "new" if i == 3 else "old" for i in range(50)}
    assert keyed_table.recover(spark, path, ["k"]) is False
    # a pending folder that is not complete is thrown away
    _rows(spark, [(4, "bad", 9)]).write.parquet(f"{path}/_pending/rows")
    os.remove(f"{path}/_pending/rows/_SUCCESS")
    assert keyed_table.recover(spark, path, ["k"]) is False
    assert read()[4] == "old"


def _record(pid, group, customers, end=""):
    lines = [f"Id:   {pid}", f"ASIN: A{pid}"]
    lines += ["  discontinued product"] if end else [
        f"  title: t{pid}", f"  group: {group}", "  salesrank: 5", "  similar: 0", "  categories: 0",
        f"  reviews: total: {len(customers)}  downloaded: {len(customers)}  avg rating: 4",
        *[f"    2000-1-{i % 28 + 1}  cutomer: {c}  rating: 4  votes:   1  helpful:   1" for i, c in enumerate(customers)]]
    return "".join(x + "\r\n" for x in lines)


def _deliver(folder, name, records, time):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write("# header\r\n\r\n" + "\r\n".join(records) + "\r\n")
    os.utime(path, (time, time))


def _counted(spark, table):
    return {(r.group, r.customer): r.comments for r in X.corrected_counters(spark, table).collect()}


def test_redelivered_products_count_once(spark, tmp_path):
    src, table, state = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    run = lambda **k: X.start_corrected_counters(spark, src, table, state, **k).awaitTermination()
    _deliver(src, "a.txt", [_record(1, "Book", ["x", "x", "y"]), _record(2, "Book", ["x"]), _record(3, "DVD", [])], 1000)
    run()
    assert _counted(spark, table) == {("Book", "x"): 3, ("Book", "y"): 1}
    _deliver(src, "b.txt", [_record(1, "Book", ["x", "x", "y"])], 2000)  # unchanged
    run()
    assert _counted(spark, table) == {("Book", "x"): 3, ("Book", "y"): 1}
    X.compact_counters(spark, table)
    # corrected: another group, a customer less, one more; and a product gone
    _deliver(src, "c.txt", [_record(1, "DVD", ["x", "z"]), _record(2, "", [], end="gone"), _record(3, "DVD", ["z"])], 3000)
    run()
    assert _counted(spark, table) == {("DVD", "x"): 1, ("DVD", "z"): 2}
    X.compact_counters(spark, table)
    assert _counted(spark, table) == {("DVD", "x"): 1, ("DVD", "z"): 2}


def test_the_newest_file_of_a_micro_batch_wins_and_its_records_add_up(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "t")
    _deliver(src, "z-old.txt", [_record(1, "Book", ["x"] * 5)], 1000)
    _deliver(src, "a-new.txt", [_record(1, "Book", ["x"]), _record(1, "Book", ["x", "y"])], 5000)
    X.start_corrected_counters(spark, src, table).awaitTermination()
    assert _counted(spark, table) == {("Book", "x"): 2, ("Book", "y"): 1}


def test_random_deliveries_equal_a_recount_after_every_run(spark, tmp_path):
    src, table, state = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    rng, last = random.Random(2), {}
    for day in range(4):
        records = []
        for pid in rng.sample(range(12), 6):
            group, customers = rng.choice(["Book", "DVD"]), [rng.choice("abcd") for _ in range(rng.randrange(5))]
            gone = rng.random() < 0.2
            last[pid] = Counter() if gone else Counter((group, c) for c in customers)
            records.append(_record(pid, group, customers, "gone" if gone else ""))
        _deliver(src, f"{day}.txt", records, 1000 + day)
        X.start_corrected_counters(spark, src, table, state, max_files_per_trigger=1).awaitTermination()
        want = sum(last.values(), Counter())
        assert _counted(spark, table) == {k: n for k, n in want.items() if n}
    assert RECORD_SEPARATOR == "\n\r\n"


def test_replay_of_a_folded_micro_batch_is_skipped(spark, tmp_path):
    src, table, state = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    _deliver(src, "a.txt", [_record(1, "Book", ["x"])], 1000)
    X.start_corrected_counters(spark, src, table, state).awaitTermination()
    X.compact_counters(spark, table)
    for f in os.listdir(f"{state}/commits"):  # as if the job died before it noted the batch as done
        os.remove(f"{state}/commits/{f}")
    X.start_corrected_counters(spark, src, table, state).awaitTermination()
    assert _counted(spark, table) == {("Book", "x"): 1}


def test_deliveries_of_many_micro_batches_are_folded(spark, tmp_path, monkeypatch):
    src, table, state = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    monkeypatch.setattr(X, "FOLD", 2)
    for day in range(5):
        _deliver(src, f"{day}.txt", [_record(1, "Book", ["x"] * (day + 1)), _record(10 + day, "Book", ["y"])], 1000 + day)
    X.start_corrected_counters(spark, src, table, state, max_files_per_trigger=1).awaitTermination()
    assert _counted(spark, table) == {("Book", "x"): 5, ("Book", "y"): 5}
    log = f"{state}/last-deliveries"
    assert store.children(spark, f"{log}/base") == ["through=3"] and store.children(spark, f"{log}/batches") == ["batch=4"]
    assert spark.read.parquet(f"{log}/base/through=3").count() == 5  # product 1 once


def test_counting_differences_runs_no_python(spark, tmp_path):
    log = str(tmp_path / "log")
    for b, customers in enumerate((["x", "x"], ["x", "z"])):
        spark.createDataFrame([("1", "Book", customers, b)], "Id string, `group` string, customers array<string>, batch long").write.parquet(f"{log}/batches/batch={b}")
    got = X.differences(spark, log, 1)
    assert sorted(tuple(r) for r in got.collect()) == [("Book", "x", -1), ("Book", "z", 1)]
    assert "Pandas" not in got._jdf.queryExecution().executedPlan().toString()


def test_merging_holds_no_file_split_in_one_map(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in range(2):
        partials.add_batch(_sums(spark, [("a", 1, 1), (None, 1, 1)]), path, b)
    plan = partials.merged(spark, path, KEYS, SUMS)._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.index("RepartitionByExpression") if "RepartitionByExpression" in plan else plan.index("Exchange"):]
    assert "Aggregate" not in below


def test_rows_put_in_place_are_not_shuffled_again(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(_rows(spark, [(i, "old", 1) for i in range(200)]), path, ["k"], "seq", 4)
    _rows(spark, [(i, "new", 2) for i in range(200)]).withColumn("bucket", keyed_table.bucket_of(["k"], 4)).write.partitionBy("bucket").parquet(f"{path}/_pending/rows")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("in-place", "in place")
    assert keyed_table.recover(spark, path, ["k"]) is True
    stages = [s for j in tracker.getJobIdsForGroup("in-place") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.v for r in keyed_table.read(spark, path).collect()} == {"new"}
    assert len(stages) == len(set(stages)) <= 2  # files listed and written: no stage that shuffles
