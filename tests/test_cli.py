"""The command line jobs, run in-process on the test session."""

import os

from tessera.__main__ import main
from tessera.operators.wordcount import word_count
from tessera.plans import questions as Q
from tessera.sinks.catalog_text import write_catalog_text
from tessera.sinks.files import read_term_counts
from tessera.sources import catalog as C
from tessera.sources.tables import table
from tessera.sources.text import write_corpus
from tests.conftest import SF_SMALL
from tests.oracle_compare import spark_rows


def test_wordcount_job(spark, tmp_path):
    corpus, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    write_corpus(spark, SF_SMALL, corpus)
    assert main(["wordcount", corpus, out, "--reducers", "5"]) == 0
    assert sorted(d for d in os.listdir(out) if d.startswith("bucket=")) == [f"bucket={i}" for i in range(5)]
    want = word_count(table(spark, SF_SMALL, "documents").select("text"))
    assert spark_rows(read_term_counts(spark, out)) == spark_rows(want)


def test_questions_job(spark, tmp_path):
    cat, out = str(tmp_path / "catalog"), str(tmp_path / "answers")
    sells = C.sells(spark, SF_SMALL)
    write_catalog_text(spark, sells, C.similars(spark, SF_SMALL), C.categories(spark, SF_SMALL),
                       C.reviews(spark, SF_SMALL), cat)
    assert main(["questions", cat, out, "--id", "6"]) == 0
    names = sorted(d for d in os.listdir(out) if d.startswith("question_"))
    assert names == ["question_a1", "question_a2", "question_b", "question_c", "question_d",
                     "question_e", "question_f", "question_g"]
    d = spark.read.option("header", True).csv(f"{out}/question_d")
    assert d.count() == Q.top_sellers_rank(sells).count()
    e = [f for f in os.listdir(f"{out}/question_e") if f.startswith("part-")]
    assert len(e) == 1  # bounded answers are one file
