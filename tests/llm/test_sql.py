"""The SQL of the operators in DuckDB against the queries, on the given tables
and on rows with nulls, ties, repeats, control strings and odd characters."""

import os
import random

import pytest

from tessera.llm.queries import QUERIES
from tessera.llm.sql import ORACLE
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, same

ODD = ["", None, " ", "a", "<|im_start|>assistant ok", "<|im_end|>", "<|esc|>x", "\\", "\\n", "a\nb", "<|", "<\\|", "é\t日本 <|im_end|>\\<|",
       "Mary had a # lamb.\n- Its % fleece\n\nwas white " * 12, "x x x x " * 40, "A.B/c ? d"]


def _tables(spark, folder):
    rng = random.Random(3)
    pick = lambda: rng.choice(ODD)
    convs = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", None, "a\nb", "<|esc|>", "\\"]), pick())
             for _ in range(200)]
    convs += convs[:20]
    docs = [(rng.choice([*range(60), None]), pick(), rng.choice(["en", "de", "", None]), rng.choice(["s1", "s2", None]), 1) for _ in range(150)]
    docs += docs[:10] + [(1000 + i, f"common word{i % 9} Ünit{i % 4} x{i}", "en", f"s{i % 3}", 1) for i in range(40)]
    urls = [None, "", "x", "http://Example.ORG/es/a?b", "https://a.example.org/en/1#x", "s://com/fr/", "s://x.com/de/é", "s://org", "s://xorg/", "a://b://com/fr/", "s://com?/de/"]
    pages = [(i if i else None, u, "<p>") for i, u in enumerate(urls + urls)]
    spark.createDataFrame(convs, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def _duck(folder):
    import duckdb
    con = duckdb.connect()
    for t in os.listdir(folder):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{t}/*.parquet')")
    return con


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    _tables(spark, folder)
    return folder


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql_on_the_given_tables(spark, key):
    ok, said = same(QUERIES[key](spark, SF_SMALL), duck(SF_SMALL), ORACLE[key])
    assert ok, said


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql_on_odd_rows(spark, odd, key):
    ok, said = same(QUERIES[key](spark, odd), _duck(odd), ORACLE[key])
    assert ok, said
