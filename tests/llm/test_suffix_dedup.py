"""Repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import suffix_dedup as S


def brute(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[k:k + 200] for _, d in data for k in range(len(d) - 199))
    out = []
    for i, d in data:
        hit = bytearray(len(d))
        for k in range(len(d) - 199):
            if seen[d[k:k + 200]] > 1:
                hit[k:k + 200] = b"\1" * 200
        runs = sum(1 for k in range(len(d)) if hit[k] and (k == 0 or not hit[k - 1]))
        kept = bytes(b for b, h in zip(d, hit) if not h)
        out.append((str(i), len(d), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(spark, rows):
    df = S.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def planted(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rnd.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a, b = sorted((rnd.randrange(len(p)), rnd.randrange(len(p))))
            parts += [p[a:b] if rnd.random() < 0.5 else p, text(rnd.randint(0, 20))]
        rows.append((i, "".join(parts)))
    return rows + [(n, rows[3][1]), (n + 1, rows[3][1]), (n + 2, rows[5][1][:150]), (None, rows[7][1])]


@pytest.mark.parametrize("large,batch,chunk", [(512, 256, 1024), (512, 4, 16), (3, 256, 1024)])
def test_planted_passages(spark, monkeypatch, large, batch, chunk):
    for k, v in (("LARGE", large), ("BATCH", batch), ("CHUNK", chunk)):
        monkeypatch.setattr(S, k, v)
    rows = planted(large + batch)
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "a" * 199), (5, "a" * 201), (6, "b" * 200), (7, "b" * 200),
            (8, "xy" * 400), (9, "\0" * 250 + "c"), (10, "é" * 150), (11, "z" * 5 + "é" * 101)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_stretches_join_without_a_seam(spark, monkeypatch):
    monkeypatch.setattr(S, "STRETCH", 300)
    rows = planted(9, 20)
    assert got(spark, rows) == brute(rows)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(spark, rows) == brute(rows)


def test_family_levels_grow_geometrically():
    rnd = random.Random(2)
    piece = lambda: bytes(rnd.randrange(256) for _ in range(230))
    pieces = [piece() for _ in range(14)]
    pieces[13] = pieces[2][:210] + pieces[13][:20]
    family = S.Family()
    for i in range(0, 14, 2):
        family.add(pieces[i:i + 2])
    assert sorted(family.levels) == [0, 1, 2]
    assert [k for k, h in enumerate(family.high) if h >= 0] == [2, 13]
    assert (family.low[2], family.high[2]) == (0, 10)


@pytest.mark.parametrize("large", [1, 2, 8])
def test_hot_passage_cut_at_many_places(spark, monkeypatch, large):
    """A passage that many texts hold, whole or from and to somewhere in it."""
    monkeypatch.setattr(S, "LARGE", large)
    rnd = random.Random(large)
    own = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = own(520)
    rows = []
    for i in range(70):
        a = rnd.choice([0, 0, rnd.randrange(200)])
        b = rnd.choice([520, 520, rnd.randrange(300, 520)])
        rows.append((i, own(rnd.randrange(150)) + passage[a:b] + own(rnd.randrange(150))))
    assert got(spark, rows) == brute(rows)
