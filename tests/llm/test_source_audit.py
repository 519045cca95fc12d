"""Source divergence audit against a brute force in exact integers, and its SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import source_audit as A
from tessera.llm.queries import QUERIES
from tessera.llm.sql import ORACLE
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, same


def _brute(docs, min_docs=3, top=200):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang].add(source)
        count[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        p = {}
        for s in sources:
            n = sum(count[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (count[lang, s][t] + 1) // (n + v) for t in kept}
        both = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        n = sum(both.values())
        q = {t: 1 + 10**9 * (both[t] + 1) // (n + v) for t in kept}
        f = lambda x, y: (x - y) * (x - y) // y
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, rows, most in (("pair", pair, None), ("term", term, top)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(rows[:most])]
    return sorted(out)


def _got(df):
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in df.collect())


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, term string, n long")


def test_whole_table_equals_brute_force_and_sql(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = QUERIES["op11_source_audit"](spark, SF_SMALL)
    assert _got(df) == _brute(rows)
    ok, said = same(df, duck(SF_SMALL), ORACLE["op11_source_audit"])
    assert ok, said


EDGES = [
    (1, "A a b é É", "en", "s1"), (2, "a b ÄB\x00ab", "en", "s2"), (3, "a éé b1b zz", "en", "s3"), (4, "a a a zz é", "en", "s1"),
    (4, "a a a zz é", "en", "s1"), (5, None, "en", "s4"), (6, "...", None, None), (None, "a b", None, "s1"), (7, "A B", "", "s1"),
    (8, "b a", "", ""), (9, "only", "xx", "s1"), (10, "", "yy", "s1"), (11, "", "yy", "s2"), (12, "abcdefgh abcdefghi abcdefgh日本", "de", "s1"),
    (13, "abcdefgh abcdefghi abcdefgh日本 " + "w" * 5000, "de", "s2"), (14, "ABCDEFGH Abcdefghi abcdefgh日本 " + "w" * 5000, "de", "s2"),
    (15, "w" * 5000 + "v " + "w" * 5000, "de", "s3"), (16, "x " * 3000, "de", "s3"),
]


def test_edge_cases(spark):
    assert _got(A.audit(_docs(spark, EDGES))) == _brute([(i, t, la, s) for i, t, la, s in EDGES])


def test_empty_table(spark):
    assert A.audit(_docs(spark, EDGES).limit(0)).collect() == []


def test_top_and_min_docs_are_parameters(spark):
    rows = [(i, f"a{'b' * (i % 7)} c{'d' * (i % 5)} e", "en", f"s{i % 3}") for i in range(60)]
    assert _got(A.audit(_docs(spark, rows), min_docs=8, top=2)) == _brute(rows, 8, 2)


@pytest.mark.parametrize("leaf", [2, 16, 4096])
def test_pointer_sort(monkeypatch, leaf):
    monkeypatch.setattr(A, "LEAF", leaf)
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 99, rng.integers(1, 30), dtype=np.uint8)) for _ in range(3000)] + [b"the"] * 2000 + [b"q" * 300] * 40
    rng.shuffle(words)
    text = b" ".join(words)
    data = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(8, np.uint8)])
    start, end, _ = A.word_spans(data[:-8], np.array([0, len(text)]), A.LETTER)
    order, first = A.sort_pointers(A.Pointers(data, start, end))
    got = [words[i] for i in order]
    assert got == sorted(words)
    assert first.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


@pytest.mark.parametrize("square,pairs", [(1024, 7), (2, 7), (2, 1 << 20)])
def test_pairs_in_small_blocks(monkeypatch, square, pairs):
    import pyarrow as pa
    monkeypatch.setattr(A, "SQUARE", square)
    monkeypatch.setattr(A, "PAIRS", pairs)
    rng = np.random.default_rng(9)
    rows = sorted((la, f"t{t}", f"s{s}", int(rng.integers(5, 100))) for la in ("de", "en") for t in range(12) for s in range(6) if rng.random() < 0.6)
    none = {(la, f"s{s}"): 3 + s for la in ("de", "en") for s in range(6)}
    table = pa.table({"lang": [r[0] for r in rows], "source": [r[2] for r in rows], "term": [r[1] for r in rows],
                      "none": [none[r[0], r[2]] for r in rows], "p": [r[3] for r in rows]})
    got = Counter()
    for batch in A.shared_pairs(iter(table.to_batches(max_chunksize=5))):
        for la, i, j, value in zip(*(c.to_pylist() for c in batch.columns)):
            got[la, i, j] += value
    want = Counter()
    f = lambda x, y: (x - y) * (x - y) // y
    for la, t, s, p in rows:
        for lb, u, o, q in rows:
            if (la, t) == (lb, u) and s != o:
                a, b = none[la, s], none[la, o]
                want[la, s, o] += f(p, q) - f(p, b) - f(a, q) + f(a, b)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
