"""Derived tables by fingerprint (SRC-13), published outputs (SNK-2), look-ups
by another key (JN-7), lists kept up to date (WIN-3)."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.lookup import lookup, lookup_join
from tessera.plans import catalog_files as CF
from tessera.plans import questions as Q
from tessera.sinks import store, versions
from tessera.sinks.query_tables import read_query_table, write_query_table
from tessera.sources import base, records
from tessera.streaming.top_lists import start_top_reviewers, top_reviewers_now
from tests.test_stored import _deliver, _record


def _catalog(path, pids, time=1000):
    _deliver(os.path.dirname(path), os.path.basename(path), [_record(p, "Book", ["x"] * (p % 3)) for p in pids], time)


def test_one_state_of_a_file_is_parsed_once(spark, tmp_path, monkeypatch):
    text, root = str(tmp_path / "in" / "cat.txt"), str(tmp_path / "shared")
    _catalog(text, [1, 2, 3])
    parsed, parse = [], records.parse_records
    monkeypatch.setattr(records, "parse_records", lambda *a, **k: parsed.append(1) or parse(*a, **k))
    for _ in range(2):  # two questions
        products = base.parsed_base(spark, text, root)
        assert records.reviews_of(products).count() == 3
    assert len(parsed) == 1
    _catalog(text, [1, 2, 3, 5], 2000)
    assert records.reviews_of(base.parsed_base(spark, text, root)).count() == 5
    assert len(parsed) == 2
    # the earlier state, if a job still reads it, is as it was
    assert len(os.listdir(root)) == 2


def test_same_length_another_time_is_another_state(spark, tmp_path):
    text, root = str(tmp_path / "in" / "cat.txt"), str(tmp_path / "shared")
    _catalog(text, [1])
    one = base.fingerprint(spark, [text], [records])
    _catalog(text, [4], 2000)
    two = base.fingerprint(spark, [text], [records])
    assert one != two
    assert base.fingerprint(spark, [text], [records, Q]) not in (one, two)
    assert [r.Id for r in base.parsed_base(spark, text, root).collect()] == ["4"]


def test_a_job_that_fails_leaves_no_base_behind(spark, tmp_path):
    text, root = str(tmp_path / "in" / "cat.txt"), str(tmp_path / "shared")
    _catalog(text, [1, 2])

    def dies(folder):
        spark.range(3).write.parquet(folder)
        raise RuntimeError("lost driver")

    with pytest.raises(RuntimeError):
        base.derived(spark, "products", [text], [records], dies, root)
    assert records.sells_of(base.parsed_base(spark, text, root)).count() == 2


def test_two_jobs_that_derive_at_once_agree(spark, tmp_path):
    text, root = str(tmp_path / "in" / "cat.txt"), str(tmp_path / "shared")
    _catalog(text, [1, 2])

    def other_is_first(folder):
        base.parsed_base(spark, text, root)
        spark.range(9).write.parquet(folder)

    got = base.derived(spark, "products", [text], [records], other_is_first, root)
    assert spark.read.parquet(got).columns[0] == "Id" and len(os.listdir(root)) == 1


def test_roundtrip_keys_share_the_parsed_catalogue(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(base, "shared_dir", lambda _: str(tmp_path / "shared"))
    rendered, render = [], CF.write_fixture_catalog
    sf = "/root/testdata/sf0.001"
    code = [CF.C, CF.catalog_text]
    monkeypatch.setattr(CF, "fixture_catalog", lambda s, d: base.derived(
        s, "catalogue", [f"{d}/part.parquet"], code, lambda folder: rendered.append(1) or render(s, d, folder)))
    n = CF.roundtrip_sells(spark, sf).count()
    assert CF.roundtrip_similars(spark, sf).count() and CF.roundtrip_stats(spark, sf).count() == n
    assert len(rendered) == 1


def test_a_failed_job_leaves_the_old_output_readable(spark, tmp_path):
    path = str(tmp_path / "out")
    assert versions.current(spark, path) is None
    versions.replace(spark, path, lambda f: spark.range(3).write.parquet(f))
    first = versions.current(spark, path)

    def dies(folder):
        spark.range(9).select(F.raise_error(F.lit("lost"))).write.parquet(folder)

    with pytest.raises(Exception, match="lost"):
        versions.replace(spark, path, dies)
    assert versions.current(spark, path) == first and spark.read.parquet(first).count() == 3
    with pytest.raises(RuntimeError):
        versions.replace(spark, path, lambda f: None)
    assert versions.current(spark, path) == first


def test_old_versions_go_but_the_last(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in range(1, 5):
        versions.replace(spark, path, lambda f, n=n: spark.range(n).write.parquet(f))
        assert spark.read.parquet(versions.current(spark, path)).count() == n
        assert len(store.children(spark, f"{path}/versions")) == min(n, 2)
    versions.replace(spark, path, lambda f: spark.range(9).write.parquet(f), keep=0)
    assert store.children(spark, f"{path}/versions") == [os.path.basename(versions.current(spark, path))]


def _scanned(df):
    """Rows that the scan of ``df`` has put out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_for_an_absent_key(spark, tmp_path):
    rows = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("Id"),
                                      F.concat(F.lit("P"), F.sha2(F.col("id").cast("string"), 256)).alias("ASIN"))
    with_filter, without = str(tmp_path / "bloom"), str(tmp_path / "plain")
    write_query_table(rows, with_filter, cluster_by=["Id"], partitions=4, look_up=["ASIN"])
    write_query_table(rows, without, cluster_by=["Id"], partitions=4)
    absent, there = "P5" + "0" * 63, rows.filter("Id = '000000777'").first().ASIN
    assert _scanned(lookup(read_query_table(spark, without), "ASIN", [absent])) == 20_000
    assert _scanned(lookup(read_query_table(spark, with_filter), "ASIN", [absent])) == 0
    found = lookup(read_query_table(spark, with_filter), "ASIN", [there, absent, None])
    assert [r.Id for r in found.collect()] == ["000000777"]
    assert _scanned(found) < 20_000
    assert lookup(read_query_table(spark, with_filter), "ASIN", []).count() == 0


def test_lookup_join_equals_a_join_and_filters_before_its_shuffle(spark):
    table = spark.range(5000).select(F.concat(F.lit("P"), "id").alias("ASIN"), (F.col("id") % 7).alias("rank"))
    asked = spark.createDataFrame([(1, "P5"), (2, "P5"), (3, "X1"), (4, None), (5, "P4999")], "n int, similar string")
    got = lookup_join(table, "ASIN", asked, "similar")
    assert got.columns == ["n", "similar", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "P5", 5), (2, "P5", 5), (5, "P4999", 4999 % 7)]
    left = sorted((tuple(r) for r in lookup_join(table, "ASIN", asked, "similar", "left").collect()), key=lambda r: r[0])
    assert left == [(1, "P5", 5), (2, "P5", 5), (3, "X1", None), (4, None, None), (5, "P4999", 4999 % 7)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "broadcast" in plan
    with pytest.raises(ValueError):
        lookup_join(table, "rank", asked, "similar")
    with pytest.raises(ValueError):
        lookup_join(table, "ASIN", asked, "similar", "full")


def test_top_lists_equal_the_question_after_every_batch(spark, tmp_path):
    src, top, state = (str(tmp_path / x) for x in ("in", "top", "state"))
    rng, reviews = random.Random(6), []
    for day in range(4):
        records_, pid = [], day * 100
        for k in range(8):
            group, customers = rng.choice(["Book", "DVD", "Toy"]), [f"c{min(rng.randrange(12), rng.randrange(12))}" for _ in range(rng.randrange(6))]
            records_.append(_record(pid + k, group, customers))
            reviews += [(group, c) for c in customers]
        _deliver(src, f"{day}.txt", records_, 1000 + day)
        start_top_reviewers(spark, src, top, 3, state).awaitTermination()
        got = sorted(tuple(r) for r in top_reviewers_now(spark, top).select("group", "customer", "comments").collect())
        counts = Counter(reviews)
        want = []
        for g in {g for g, _ in counts}:
            want += [(g, c, n) for (_, c), n in sorted(((k, n) for k, n in counts.items() if k[0] == g), key=lambda x: (-x[1], x[0][1]))[:3]]
        assert got == sorted(want)
        all_reviews = spark.createDataFrame(reviews, "`group` string, customer string")
        assert got == sorted(tuple(r) for r in Q.top_reviewers(all_reviews, 3).collect())
    assert len(store.children(spark, top)) == 2  # older lists are gone


def test_a_replayed_batch_gives_the_same_list(spark, tmp_path):
    src, top, state = (str(tmp_path / x) for x in ("in", "top", "state"))
    for day in range(2):
        _deliver(src, f"{day}.txt", [_record(day, "Book", ["x"] * (day + 1) + ["y"] * 2)], 1000 + day)
        start_top_reviewers(spark, src, top, 1, state).awaitTermination()
    before = [tuple(r) for r in top_reviewers_now(spark, top).collect()]
    os.remove(f"{state}/commits/1")  # as if the job died before it noted the batch as done
    if os.path.exists(f"{state}/commits/.1.crc"):
        os.remove(f"{state}/commits/.1.crc")
    start_top_reviewers(spark, src, top, 1, state).awaitTermination()
    assert [tuple(r) for r in top_reviewers_now(spark, top).collect()] == before == [("Book", "y", 4)]
    with pytest.raises(ValueError):
        top_reviewers_now(spark, str(tmp_path / "none"))


def test_shared_catalogue_text_is_packed(spark):
    from tests.conftest import SF_SMALL
    path = CF.fixture_catalog(spark, SF_SMALL)
    stored = sum(length for _, length, _ in store.listing(spark, path))
    text = spark.read.text(path).selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert 0 < 2 * stored < text
