"""Streaming ingest, sinks and small helpers."""

import os

from pyspark.sql import functions as F

from tessera.functions.format import two_decimals
from tessera.operators.aggregates import numeric_means
from tessera.plans import questions as Q
from tessera.sinks.catalog_text import write_catalog_text
from tessera.sinks.files import read_term_counts, write_csv, write_term_counts
from tessera.sources import catalog as C
from tessera.sources import records as R
from tessera.streaming.ingest import compact_changelog, current_counters, start_review_counters
from tests.conftest import SF_SMALL
from tests.oracle_compare import spark_rows


def _catalog_file(spark, tmp, products):
    """Render the catalogue of the given product ids to ``tmp``."""
    ids = F.col("Id").isin([str(i) for i in products])
    write_catalog_text(spark, C.sells(spark, SF_SMALL).filter(ids), C.similars(spark, SF_SMALL).filter(ids),
                       C.categories(spark, SF_SMALL).filter(ids), C.reviews(spark, SF_SMALL).filter(ids),
                       str(tmp), partitions=2)


def test_stream_counters_fold_new_files(spark, tmp_path):
    src = tmp_path / "incoming"
    log, ckpt = str(tmp_path / "changelog"), str(tmp_path / "ckpt")
    # every catalogue delivery is a folder of part files; the stream watches src/*
    _catalog_file(spark, src / "a", range(0, 100))
    start_review_counters(spark, str(src / "*"), log, ckpt).awaitTermination()
    first = current_counters(spark, log).count()
    _catalog_file(spark, src / "b", range(100, 200))
    start_review_counters(spark, str(src / "*"), log, ckpt).awaitTermination()
    assert current_counters(spark, log).count() >= first
    got = current_counters(spark, log)
    want = Q.reviews_per_customer(C.reviews(spark, SF_SMALL))
    assert spark_rows(got) == spark_rows(want)
    snap = compact_changelog(spark, log, str(tmp_path / "snapshot"))
    assert spark.read.parquet(snap).count() == got.count()
    assert spark_rows(current_counters(spark, snap)) == spark_rows(want)


def test_term_count_part_files(spark, tmp_path):
    counts = spark.createDataFrame([("zed", 1), ("aaron", 96), ("a-breeding", 1), ("zodiac", 1)],
                                   "term string, count long")
    write_term_counts(counts, str(tmp_path / "out"), 5)
    assert sorted(f for f in os.listdir(tmp_path / "out") if not f.startswith(".")) == ["_SUCCESS", "bucket=0", "bucket=4"]
    part4 = sorted(f for f in os.listdir(tmp_path / "out" / "bucket=4") if f.startswith("part-"))
    lines = [line for f in part4 for line in open(tmp_path / "out" / "bucket=4" / f).read().splitlines()]
    assert lines == ["zed\t1", "zodiac\t1"]  # tab separated, byte-sorted
    back = read_term_counts(spark, str(tmp_path / "out"))
    assert spark_rows(back) == spark_rows(counts)
    # SNK-2: writing again replaces the output
    write_term_counts(counts.limit(1), str(tmp_path / "out"), 5)
    assert read_term_counts(spark, str(tmp_path / "out")).count() == 1


def test_csv_default_mode_refuses_existing_output(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    write_csv(df, str(tmp_path / "c"))
    try:
        write_csv(df, str(tmp_path / "c"))
        raise AssertionError("expected the second write to fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_two_decimals(spark):
    df = spark.createDataFrame([(3.14159,), (2.0,), (None,)], "x double")
    assert [r.x for r in df.select(two_decimals("x").alias("x")).collect()][:2] == ["3.14", "2.00"]


def test_single_file_csv_of_many_rows_is_whole(spark, tmp_path):
    write_csv(spark.range(150_000), str(tmp_path / "big"), single_file=True)
    files = [f for f in os.listdir(tmp_path / "big") if f.startswith("part-")]
    assert len(files) == 1 and spark.read.csv(str(tmp_path / "big")).count() == 150_000


def test_term_count_tasks_share_the_buckets(spark, tmp_path):
    from tessera.operators.wordcount import with_bucket
    counts = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("term"), F.lit(1).cast("long").alias("count"))
    write_term_counts(counts, str(tmp_path / "out"), 5)
    want = with_bucket(counts, 5).groupBy("bucket").count().collect()
    assert len(want) == 5
    tasks = set()
    for r in want:
        folder = tmp_path / "out" / f"bucket={r.bucket}"
        lines = 0
        for f in sorted(os.listdir(folder)):
            if f.startswith("part-"):
                tasks.add(f.split("-")[1])
                part = open(folder / f).read().splitlines()
                assert part == sorted(part)
                lines += len(part)
        assert lines == r["count"]
    assert len(tasks) == 5  # no task idles


def test_question_tables_are_in_answer_order(spark, tmp_path):
    from tessera.sinks.query_tables import QUESTION_TABLES, write_question_table
    sells, similars, reviews = C.sells(spark, SF_SMALL), C.similars(spark, SF_SMALL), C.reviews(spark, SF_SMALL)
    for name, (_, cluster, order, parts) in QUESTION_TABLES.items():
        path = str(tmp_path / name)
        write_question_table(name, path, sells, similars, reviews)
        for folder, _, files in os.walk(path):
            for f in files:
                if f.startswith("part-"):
                    rows = spark.read.parquet(os.path.join(folder, f)).coalesce(1).collect()
                    key = lambda r: tuple([r[c] for c in cluster if c not in parts] + [
                        -r[o[0]] if isinstance(o, tuple) else r[o] for o in order])
                    assert [key(r) for r in rows] == sorted(key(r) for r in rows), name


def test_numeric_means(spark):
    df = spark.createDataFrame([("d1", 1, 2.0, "x"), ("d1", 3, 4.0, "y"), ("d2", 5, 6.0, "z")],
                               "date string, rating int, votes double, customer string")
    got = {r.date: (r.avg_rating, r.avg_votes) for r in numeric_means(df, ["date"]).collect()}
    assert got == {"d1": (2.0, 3.0), "d2": (5.0, 6.0)}


def test_parse_of_rendered_catalogue(spark, tmp_path):
    _catalog_file(spark, tmp_path / "cat", range(0, 50))
    products = R.parse_records(R.read_records(spark, str(tmp_path / "cat")))
    ids = F.col("Id").isin([str(i) for i in range(50)])
    assert spark_rows(R.sells_of(products)) == spark_rows(C.sells(spark, SF_SMALL).filter(ids))


def test_single_file_csv_is_in_report_order(spark, tmp_path):
    sells = C.sells(spark, SF_SMALL)
    write_csv(Q.top_sellers_rank(sells), str(tmp_path / "d"), single_file=True, order=["group", "salesrank", "Id"])
    files = [f for f in os.listdir(tmp_path / "d") if f.startswith("part-")]
    assert len(files) == 1
    rows = [line.split(",") for line in open(tmp_path / "d" / files[0]).read().splitlines()]
    keys = [(r[0], int(r[3]), r[1]) for r in rows]
    assert keys == sorted(keys)


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from tessera.sinks.query_tables import write_bucketed
    from tessera.sources.tables import table
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey")
    a = write_bucketed(li, "t_lineitem_b", ["l_orderkey"], 8, str(tmp_path / "li"))
    b = write_bucketed(od, "t_orders_b", ["o_orderkey"], 8, str(tmp_path / "od"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b, a["l_orderkey"] == b["o_orderkey"]).groupBy("l_orderkey").agg(F.sum("l_quantity"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert j.count() == li.select("l_orderkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_query_table_splits_a_hot_key(spark, tmp_path):
    """A clustering key holding every row is still written by several tasks."""
    from tessera.sinks.query_tables import read_query_table, write_query_table
    r = C.reviews(spark, SF_SMALL).withColumn("Id", F.lit("6"))
    path = str(tmp_path / "hot")
    write_query_table(r, path, cluster_by=["Id"], order=[F.col("helpful").desc(), F.col("rating").desc()],
                      partitions=8)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 1
    assert read_query_table(spark, path).count() == r.count()


def test_csv_round_trip_with_commas_and_quotes(spark, tmp_path):
    from tessera.plans.catalog_files import SELLS_SCHEMA
    from tessera.sinks.files import read_csv
    rows = [("1", "A001", 'Part one, "the beginning"', "Book", 10, 2),
            ("2", "A002", "Back\\slash; semi", "DVD", -1, 0)]
    df = spark.createDataFrame(rows, SELLS_SCHEMA)
    write_csv(df, str(tmp_path / "c"))
    assert spark_rows(read_csv(spark, str(tmp_path / "c"), SELLS_SCHEMA)) == spark_rows(df)
