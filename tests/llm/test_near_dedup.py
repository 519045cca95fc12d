"""Near-dedup against brute force on whole tables and on planted groups."""

import random
import re

import pytest

from tessera.llm import near_dedup as N
from tessera.llm.components import components


def brute_sets(rows):
    out = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(rows):
    sets = brute_sets(rows)
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = [i for i in sorted(sets) if sets[i]]
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) >= 75 * max(len(a), len(b)):
                inter = len(a & b)
                if 100 * inter >= 75 * (len(a) + len(b) - inter):
                    p, q = sorted((root(i), root(j)))
                    up[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_dedup(df).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block,large", [(128, 1024), (8, 1024), (8, 5)])
def test_blob_of_near_copies(spark, monkeypatch, block, large):
    """Copies of one text with random edits: links are not transitive, hubs don't see all."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "LARGE", large)
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(90)]
    rows = []
    for i in range(140):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 9999)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"u{rnd.randint(0, 9999)}" for _ in range(60))) for i in range(30)]
    rows += [(2000 + i, rows[3][1].upper()) for i in range(20)]
    assert got(frame(spark, rows)) == brute(rows)


def test_edges(spark):
    long = " ".join(f"l{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, long), (8, long + " end"), (9, "ÉÉ one two"), (10, "éé one two")]
    want = brute(rows)
    assert want[5] == (1, 4, False) and want[8][1] == 7 and want[9][1] == 9 and want[10][1] == 10
    assert got(frame(spark, rows)) == want
    assert N.near_dedup(frame(spark, [])).count() == 0
    out = N.near_dedup(frame(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [("1", "1", True), ("1", "1", True), ("None", "None", True)]


def test_keep_one_keeps_columns(spark):
    rows = [(i, "a b c d e f g h", "x", True, 1) for i in range(5)] + [(None, "q", "y", False, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string, kept boolean, component_id int")
    out = N.keep_one(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["0", "None"]


@pytest.mark.parametrize("chunks,rows", [N.FIRST, N.SECOND])
def test_chunk_keys_find_every_single_error(chunks, rows):
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, chunks * rows).astype("<u4")
    b = a.copy()
    b[::rows] ^= 1  # one error in every chunk
    assert len(np.intersect1d(N.chunk_keys(a, chunks, rows), N.chunk_keys(b, chunks, rows))) == chunks
    b[1::rows] ^= 1  # two errors everywhere but in the first chunk: still found
    b[1] ^= 1
    assert len(np.intersect1d(N.chunk_keys(a, chunks, rows), N.chunk_keys(b, chunks, rows))) == 1


def test_sketches_of_similar_sets_are_near():
    import numpy as np

    c, rng, far = N.constants(), np.random.default_rng(1), 0
    for _ in range(200):
        h = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        bits = [np.packbits((N.minhashes(x, c["sketch"]) & np.uint64(1)).astype(np.uint8)).tobytes() for x in (h[:438], h[62:])]  # J = 0.752
        far += not N.sketch_forest([1, 2], bits)
    assert far == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (1, 0)]
    got_ = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got_ == {**{i: 0 for i in range(41)}, **{200 + i: 100 for i in range(50)}, 100: 100}


A, B, C_ = "a b c d e f g h i j", "q r s t u v w x y z", "k l m n o p q1 r1 s1 t1"


def test_a_doc_id_with_two_texts(spark):
    df = frame(spark, [(3, A), (5, A), (5, B), (9, B), (None, A), (4, None), (4, C_)])
    out = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in N.near_dedup(df).collect())
    # 5 reaches 3 by one text and 9 by the other
    assert out == [("3", "3", True), ("4", "4", True), ("4", "4", True), ("5", "3", False), ("5", "3", False), ("9", "3", False), ("None", "None", True)]
    # one document of each group of like texts stays, so no text is lost
    kept = sorted(((r.doc_id, r.text) for r in N.keep_one(df).collect()), key=str)
    assert kept == sorted([(3, A), (5, B), (None, A), (4, None), (4, C_)], key=str)


def test_versions_of_a_representative_are_told_apart(spark):
    df = frame(spark, [(3, A), (3, B), (7, B + " end"), (8, A + " end"), (3, A)])
    assert {(r.doc_id, r.component_id) for r in N.near_dedup(df).collect()} == {(3, 3), (7, 3), (8, 3)}
    assert sorted((r.doc_id, r.text) for r in N.keep_one(df).collect()) == [(3, A), (3, A), (3, B)]
