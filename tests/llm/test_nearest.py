"""Nearest neighbours against brute force: recall, scores, ties, edge cases."""

import math

import numpy as np
import pytest

from tessera.llm import nearest as N
from tessera.llm.queries import QUERIES
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>, far double, score string"


def _ok(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _brute(rows, k=5, every=50):
    """{query: [(rank, id, score)]} by float64 cosine, in blocks of queries."""
    rows = list({(i, tuple(v)) for i, v in rows if i is not None and _ok(v)})
    if not rows:
        return {}
    dim = max(len(v) for _, v in rows)
    a = np.array([list(v) + [0.0] * (dim - len(v)) for _, v in rows])
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = (a[q] * a).sum(axis=1) / np.sqrt((a[q] ** 2).sum() * (a ** 2).sum(axis=1))
        order = np.lexsort((ids, -score))
        order = [o for o in order if ids[o] != ids[q]][:k]
        out[int(ids[q])] = [(r + 1, int(ids[o]), float(score[o])) for r, o in enumerate(order)]
    return out


def _got(df):
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def _recall(got, want):
    assert set(got) == set(want) and all([x[0] for x in got[q]] == [x[0] for x in want[q]] for q in want)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in want[q]}) for q in want)
    return hits / sum(len(x) for x in want.values())


def _true_scores(got, rows):
    at = {i: np.array(v, float) for i, v in rows if i is not None and _ok(v)}
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        for _, i, score in found:
            a, b = at[q], at[i]
            assert score == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)), abs=1e-12)


@pytest.mark.parametrize("sf_dir", [SF_CHECK, "/root/testdata/sf0.1"])
def test_recall_on_whole_table(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(N, "BLOCK", 256)  # several cells and blocks
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = _got(QUERIES["op12_nearest"](spark, sf_dir)), _brute(rows)
    assert _recall(got, want) >= 0.95
    _true_scores(got, rows)


def _clustered(n, seed=0, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, dim))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(30)] + 0.3 * rng.standard_normal(dim)]) for i in range(n)]


@pytest.mark.parametrize("block,cells,queries", [(200, 4, 1 << 16), (60, 64, 7), (100_000, 1024, 1 << 16)])
def test_cells_blocks_and_chunks(spark, monkeypatch, block, cells, queries):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "MAX_CELLS", cells)
    monkeypatch.setattr(N, "QUERIES", queries)
    rows = _clustered(1500)
    got = _got(N.nearest(spark.createDataFrame([(*r, 1.0, "s") for r in rows], SCHEMA)))
    assert _recall(got, _brute(rows)) >= 0.95
    _true_scores(got, rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000 + i, [-1.0, float(i), 0.5]) for i in range(50)]
    got = _got(N.nearest(spark.createDataFrame([(*r, 1.0, "s") for r in rows], SCHEMA)))
    assert [x[1] for x in got[350]] == [0, 1, 2, 3, 4]
    assert [x[1] for x in got[0]] == [1, 2, 3, 4, 5]
    assert _recall(got, _brute(rows)) == 1


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [2.0, 0.0]), (100, None), (150, [0.0, 0.0]), (200, [nan, 1.0]), (250, [inf, 1.0]),
            (300, [None, 1.0]), (350, []), (None, [1.0, 0.0]), (1, [1.0, 1.0, 0.0]), (2, [1.0]), (3, [1e-30, 1e-30]), (400, [3e38, 3e38])]
    got = _got(N.nearest(spark.createDataFrame([(*r, 1.0, "s") for r in rows], SCHEMA)))
    want = _brute([(i, [np.float32(x) if x is not None else None for x in v] if v else v) for i, v in rows])
    assert set(got) == {0, 50, 400}
    # 1, 3 and 400 point the same way, up to rounding
    assert {q: [x[1] for x in v][:2] for q, v in got.items() if q != 400} == {0: [2, 50], 50: [0, 2]}
    assert {x[1] for x in got[0][2:]} == {1, 3, 400} and {x[1] for x in got[400][:2]} == {1, 3}
    assert _recall(got, want) == 1


def test_few_candidates_and_empty_tables(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 1.0, "s")], SCHEMA)
    assert N.nearest(one).collect() == []
    assert N.nearest(one.limit(0)).collect() == []
    two = one.unionByName(spark.createDataFrame([(7, [1.0, 2.5], 1.0, "s")], SCHEMA))
    assert [x[1] for x in _got(N.nearest(two))[0]] == [7]
    assert N.nearest(two.filter("vec_id = 7")).collect() == []


def test_an_id_with_two_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    got = N.nearest(spark.createDataFrame([(*r, 1.0, "s") for r in rows], SCHEMA), k=1).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(50, 1, 1), (50, 1, 2)]


def test_chi_square():
    # for 2 dimensions the distribution is 1 - exp(-x / 2)
    assert N.chi2_cdf(3.0, 2) == pytest.approx(1 - math.exp(-1.5))
    rng = np.random.default_rng(1)
    draws = (rng.standard_normal((200_000, N.DIMS)) ** 2).sum(axis=1)
    assert (draws < N.chi2_bound(0.9, N.DIMS)).mean() == pytest.approx(0.9, abs=0.005)


def test_projected_distance_is_chi_square(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = N.unit(rng.standard_normal((2, 16)))
    ratios = []
    for seed in range(2000):
        monkeypatch.setattr(N, "SEED", seed)
        p = N.projection(16)
        ratios.append(((a @ p - b @ p) ** 2).sum() / ((a - b) ** 2).sum())
    for sure in (0.5, 0.9, 0.97):
        assert np.mean(np.array(ratios) < N.chi2_bound(sure, N.DIMS)) == pytest.approx(sure, abs=0.03)
