"""One part file per hash bucket (SNK-1, SNK-6, SRT-8)."""

import os

from pyspark.sql import functions as F

from tessera.operators.wordcount import bucket_edges, with_bucket
from tessera.plans.wordcount import part_edges_from_files, wordcount
from tessera.sinks.files import read_term_counts, write_part_files
from tessera.sinks.reports import read_part_lines
from tests.conftest import SF_SMALL
from tests.oracle_compare import spark_rows


def _parts(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def test_exactly_n_sorted_files_each_with_its_bucket(spark, tmp_path):
    path = str(tmp_path / "out")
    counts = wordcount(spark, SF_SMALL)
    write_part_files(counts, path, 5)
    files = _parts(path)
    assert [f[:10] for f in files] == [f"part-{i:05d}" for i in range(5)]
    want = {}
    for r in with_bucket(counts, 5).collect():
        want.setdefault(r.bucket, []).append((r.term, r["count"]))
    for i, f in enumerate(files):
        lines = [tuple(x.split("\t")) for x in open(f"{path}/{f}", encoding="utf-8").read().splitlines()]
        assert [(t, int(n)) for t, n in lines] == sorted(want[i], key=lambda x: x[0].encode())
    assert spark_rows(read_term_counts(spark, path)) == spark_rows(counts)


def test_buckets_without_terms_and_no_terms(spark, tmp_path):
    path = str(tmp_path / "out")
    counts = spark.createDataFrame([("zed", 1), ("aaron", 96), ("zodiac", 1)], "term string, count long")
    write_part_files(counts, path, 5)
    assert [f[:10] for f in _parts(path)] == [f"part-{i:05d}" for i in range(5)]
    assert spark_rows(read_term_counts(spark, path)) == spark_rows(counts)
    write_part_files(counts.limit(0), path, 3)  # replaces
    assert len(_parts(path)) == 3 and read_term_counts(spark, path).count() == 0


def test_edges_read_from_files_equal_edges_of_the_counts(spark):
    got = part_edges_from_files(spark, SF_SMALL, n=7)
    want = bucket_edges(with_bucket(wordcount(spark, SF_SMALL), 7))
    assert spark_rows(got.select(*want.columns)) == spark_rows(want)


def test_lines_of_split_files_are_numbered_through(spark, tmp_path):
    path = str(tmp_path / "out")
    write_part_files(spark.range(3000).select(F.format_string("w%05d", "id").alias("term"), F.col("id").alias("count")), path, 2)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3000")
        rows = read_part_lines(spark, path).collect()
    finally:
        spark.conf.set(key, before)
    for part in (0, 1):
        own = sorted((r.line, r.value) for r in rows if r.part == part)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and {r["lines"] for r in rows if r.part == part} == {len(own)}
        assert [v for _, v in own] == sorted(v for _, v in own)
