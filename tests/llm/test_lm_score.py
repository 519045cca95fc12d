"""Pseudo-likelihood against a plain loop, and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np

from tessera.llm import lm_score as L


def plain(p, seq, i):
    """log P of position i by loops over the definition."""
    h = p["bias"].astype(float).copy()
    for k, o in enumerate(L.OFFSETS):
        h += p["table"][k][seq[i + o] if 0 <= i + o < len(seq) else L.VOCAB]
    h = np.tanh(h)
    c, m = divmod(int(seq[i]), L.MEMBERS)
    a = [float(h @ p["class_w"][:, j] + p["class_b"][j]) for j in range(L.CLASSES)]
    b = [float(h @ p["member_w"][c][:, j] + p["member_b"][c][j]) for j in range(L.MEMBERS)]
    return a[c] - math.log(sum(map(math.exp, a))) + b[m] - math.log(sum(map(math.exp, b)))


def language(seed, n):
    """Texts whose every word follows from its neighbours, mostly."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        w, k = [], rnd.randrange(40)
        for _ in range(rnd.randint(5, 80)):
            w.append(f"w{k}")
            k = (k + 1) % 40 if rnd.random() < 0.9 else rnd.randrange(40)
        out.append(" ".join(w))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_scores_equal_a_plain_loop(spark):
    texts = language(1, 5) + ["one", "", None, "A a"]
    flat = L.initial() * 3
    got = {r.doc_id: r for r in L.score(frame(spark, texts), flat).collect()}
    for i, t in enumerate(texts):
        seq = L.buckets(t)
        want = sum(plain(L.unpack(flat), seq, j) for j in range(len(seq)))
        assert got[i].n_tokens == len(seq) and abs(got[i].score - want) < 1e-3 * max(1, len(seq))
    assert got[7].mean_score is None and L.score(frame(spark, []), flat).count() == 0


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(6)
    flat = L.initial().astype(np.float64) * 3
    seq = np.concatenate([rng.integers(0, 64, 40), rng.integers(0, L.VOCAB, 20)]).astype(np.int16)
    context = L.windows(seq)
    loss = lambda f: -L.log_probabilities(L.unpack(f), seq, context).sum()
    moved = L.Trainer(flat)
    moved.learn(seq, context)
    step = flat - moved.flat  # RATE * g / sqrt(1 + g * g)
    touched = np.flatnonzero(step)
    for at in [*rng.choice(touched, 60, replace=False), *rng.choice(np.flatnonzero(step == 0), 10)]:
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        g = (loss(up) - loss(down)) / 2e-5
        assert abs(step[at] - L.RATE * g / np.sqrt(1 + g * g)) < 1e-5, at


def test_training_steps_raise_the_likelihood():
    rng = np.random.default_rng(0)
    seq = rng.integers(0, L.VOCAB, 50)
    context = L.windows(seq)
    flat = L.initial()
    moved = L.Trainer(flat)
    for _ in range(30):
        moved.learn(seq, context)
    assert L.log_probabilities(moved.p, seq, context).sum() > L.log_probabilities(L.unpack(flat), seq, context).sum() + 50


def test_training_helps_on_held_out_texts(spark):
    flat = L.train(frame(spark, language(2, 3000)).repartition(3))
    held = language(3, 60)
    rnd = random.Random(4)
    mixed = [" ".join(rnd.sample(t.split(), len(t.split()))) for t in held]
    mean = lambda f, texts: sum(r.score for r in L.score(frame(spark, texts), f).collect()) / sum(len(t.split()) for t in texts)
    assert mean(flat, held) > mean(L.initial(), held) + 2
    assert mean(flat, held) > mean(flat, mixed) + 0.5
    again = L.train(frame(spark, language(2, 3000)).repartition(3))
    assert np.array_equal(flat, again)


def test_edges(spark):
    assert np.array_equal(L.train(frame(spark, [])), L.initial())
    assert len(L.train(frame(spark, [None, " ", "x"]))) == L.flat_size()
    long = " ".join("abcdefgh"[i % 8] for i in range(30000))
    assert L.score(frame(spark, [long]), L.initial()).first().n_tokens == 30000


def test_words_of_a_bucket_have_their_own_probability(spark):
    """Words are drawn so that two of them share each of a few buckets."""
    by: dict[int, list[str]] = {}
    for i in range(6000):
        by.setdefault(int(L.buckets(f"v{i}")[0]), []).append(f"v{i}")
    (often, seldom, unseen), *more = [v[:3] for v in by.values() if len(v) >= 3][:30]
    long = "x" * 40
    texts = [f"{often} " * 50 + f"{seldom} {seldom} {long} {long}", *(" ".join([a] * 7 + [b] * 3) for a, b, _ in more), seldom, often, unseen, f"{often} {unseen} {long}", "", None, seldom]
    corpus = texts[:len(more) + 1] + [seldom, often]
    counted = Counter(w for t in corpus for w in t.split())
    in_bucket = Counter()
    for w, n in counted.items():
        in_bucket[int(L.buckets(w)[0])] += n
    counts = L.count_words(frame(spark, corpus).repartition(3))
    assert sorted(r.n for r in counts.collect()) == sorted(counted.values())
    flat = L.initial() * 3
    plain_rows = {r.doc_id: r.score for r in L.score(frame(spark, texts), flat).collect()}
    for most in (L.HELD, 10, 0):  # all held, some joined, all joined
        rows = {r.doc_id: r for r in L.score(frame(spark, texts), flat, counts, most).collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            want = plain_rows[i] + sum(math.log(max(1, counted[w]) / (in_bucket[int(L.buckets(w)[0])] + 1)) for w in (t or "").split())
            assert abs(rows[i].score - want) < 1e-4 and (rows[i].mean_score is None) == (not t)
        one = {t: rows[i].score for i, t in enumerate(texts)}
        assert one[often] > one[seldom] > one[unseen]


def test_query_scores_words(spark):
    from tessera.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_lm_score(spark, "/root/testdata/sf0.001").collect()}
    alone = {r.doc_id: r for r in L.score(docs, L.train(docs)).collect()}
    assert got.keys() == alone.keys() and all(got[i].n_tokens == alone[i].n_tokens for i in got)
    assert all(got[i].score < alone[i].score for i in got if got[i].n_tokens)


def test_null_ids_repeated_rows_and_clashing_names(spark):
    rows = [(None, "a b c", 1, 2, "w", "k"), (4, "a b", 1, 2, "w", "k"), (4, "a b", 3, 4, "w", "k"), (5, None, 0, 0, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, task int, row int, words string, known string")
    counts = L.count_words(df)
    out = L.score(df, L.initial(), counts, most=0).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_tokens, r.score))
    assert {k: len(v) for k, v in by.items()} == {None: 1, 4: 2, 5: 1}
    assert by[4][0] == by[4][1] and by[4][0][0] == 2 and by[5] == [(0, 0.0)]
    empty = df.limit(0)
    assert L.score(empty, L.initial(), L.count_words(empty)).collect() == []
