"""Importance resampling against a brute force with zlib's CRC-32."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm import importance as I
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _features(text):
    w = _words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _brute(docs, target, percent=5, min_words=20):
    buckets = lambda text: [zlib.crc32(f.encode()) % 10000 for f in _features(text)]
    s, t = [0] * 10000, [0] * 10000
    for _, x in docs:
        for b in buckets(x):
            s[b] += 1
    for x in target:
        for b in buckets(x):
            t[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets(x))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(_features(x)), weight, score, len(_words(x)) >= min_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=str)


def _got(df):
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert _got(QUERIES["op13_importance"](spark, SF_SMALL)) == _brute(docs, target)


def test_edge_cases(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["Ä", "b2", "cc", "日本語", "x" * 130, "É" * 70]) for _ in range(n))
    docs = [(i, text(rng.randrange(18, 60))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " .,;\n"), (None, text(30)), (7, docs[7][1]), (7, text(25)), (103, "w" * 70_000 + " b " * 30),
             (104, "a" * 128 + " " + "b" * 127 + "." + "c" * 300 + "\x00d e")]
    df = spark.createDataFrame([(i, x, i, "q") for i, x in docs], "doc_id long, text string, bucket long, n_words string")
    target = spark.createDataFrame([("cc cc", 1), (None, 2), (docs[0][1], 3)], "text string, item_id long")
    got = _got(I.resample(df, target, percent=40))
    assert got == _brute(docs, ["cc cc", None, docs[0][1]], percent=40)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert I.resample(docs.limit(0), docs).collect() == []
    assert _got(I.resample(docs, docs.limit(0))) == _brute([(1, "a b c")], [])


@pytest.mark.parametrize("near", [I.NEAR])
def test_crc_of_spans_of_all_lengths(near):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    size = np.concatenate([np.arange(1, 3 * near + 3), [1000, 4096, 15_000]])
    lo = rng.integers(0, len(data) - size + 1)
    got = I.span_crc(data, lo, lo + size)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(lo, lo + size)]


def test_small_blocks_give_the_same(monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcé9") for _ in range(rng.choice([1, 3, 9, 60, 200]))) for _ in range(400)]
    text = " ".join(words)
    data = np.frombuffer(text.encode(), np.uint8)
    want = sorted(zlib.crc32(f.encode()) for f in _features(text))
    for lookups in (64, 1000, 1 << 21):
        monkeypatch.setattr(I, "LOOKUPS", lookups)
        joined, start, end, _ = I.joined_words(data, np.array([0, len(data)]))
        crc, there = I.feature_crcs(joined, start, end, np.arange(len(start)))
        assert sorted(crc[there].tolist()) == want
