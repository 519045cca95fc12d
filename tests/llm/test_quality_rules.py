"""Quality rules against a plain Python count."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, x in enumerate(win) if win.count(x) > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit))


def judged(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in Q.judge(df).collect()}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t*|é ", max_size=60), min_size=1, max_size=30))
def test_counts_equal_brute_force(spark, texts):
    got = judged(spark, texts)
    for i, t in enumerate(texts):
        assert tuple(got[i][k] for k in Q.BASE) == brute(t)


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join("the " + str(i).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(30000))
    got = judged(spark, [None, "", " \n ", long, long, "a b c " * 40])
    assert [got[i].n_words for i in range(6)] == [0, 0, 0, 60000, 60000, 120]
    assert [got[i].kept for i in range(6)] == [False, False, False, True, True, False]
    assert got[5].n_repeat_words == 120 and got[5].base_failed


def test_table_queries_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r[k] for k in Q.BASE) for r in Q.judge(docs).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == brute(r.text)


def test_filter_keeps_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "the cat and the dog " * 3 + " ".join(f"w{i}" for i in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), "x", 5),
                                (2, "short", "y", 6)], "doc_id long, text string, quality string, n_words int")
    out = Q.filter_docs(df)
    assert out.columns == df.columns
    assert [tuple(r)[0] for r in out.collect()] == [1]
    assert Q.filter_docs(df.limit(0)).count() == 0 and Q.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule", [r[0] for r in Q.RULES])
def test_each_rule_rejects_its_junk(spark, rule):
    body = " ".join(f"the word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    junk = {"symbol_ratio": body + " ***" * 60, "word_length": " ".join("abcdefghij"[i % 10] for i in range(200)),
            "stop_word_ratio": body.replace("the", "qq"), "digit_ratio": body + " 123456789" * 80,
            "dup_line_ratio": "\n".join([body] + ["the same line here"] * 9),
            "bullet_line_ratio": "\n".join(f"- {w} the" for w in body.split())}[rule]
    df = spark.createDataFrame([(1, body), (2, junk)], "doc_id long, text string")
    one = [r for r in Q.RULES if r[0] == rule]
    got = {r.doc_id: r[1] for r in df.select("doc_id", *[v.alias(k) for k, v in Q.metrics(df.text).items()])
           .select("doc_id", Q.compile_rules(one).alias("ok")).collect()}
    assert got == {1: True, 2: False}
