"""Packing: ids of the library, exact cover, little padding, optimal fills."""

import random
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing as K

PATH = P.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n\t\x1c\xa0s\u3000é中1.,", max_size=40),
                 st.lists(st.sampled_from(["<|endoftext|>", " ", "a", "\n"]), max_size=9).map("".join)))
def test_ids_are_the_library_s(text):
    words = getattr(K, "_w", None) or K.Words(PATH)
    K._w = words
    assert K.encode([text], words)[0] == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), min_size=1, max_size=6), st.integers(20, 40))
def test_fill_is_the_closest_multiset(counts, capacity):
    sums = {0}
    for k, v in counts.items():
        sums = {s + k * t for s in sums for t in range(v + 1)}
    used = K.best_fill(dict(counts), capacity)
    assert all(0 < n <= counts[k] for k, n in used.items())
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= capacity)


def test_the_closest_fill_goes_before_a_power_of_two():
    assert K.best_fill({2047: 1, 1024: 1}, 2048) == {2047: 1}
    out = K.pack_lengths({2047: 1, 1024: 1, 600: 1, 400: 1}, 2048)
    assert sorted(sum(k * n for k, n in p.items()) * times for p, times in out) == [2024, 2047]


def test_vocabularies_whose_ranks_don_t_give_their_ids_are_left_to_the_library():
    import copy
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    assert len(K.byte_ranks(spec, TOKENIZER)) == len(spec["model"]["vocab"])
    for change in (lambda s: s["model"]["merges"].reverse(), lambda s: s["model"].update(dropout=0.1), lambda s: s.update(normalizer={"type": "NFC"}),
                   lambda s: s["pre_tokenizer"].update(add_prefix_space=True), lambda s: s["model"]["vocab"].pop("a")):
        other = copy.deepcopy(spec)
        change(other)
        assert K.byte_ranks(other, TOKENIZER) is None
    words = K.Words(PATH)
    words.ranked = None
    assert words.ids("a <|endoftext|>b") == K.Words(PATH).ids("a <|endoftext|>b") == TOKENIZER.encode("a <|endoftext|>b").ids


def test_what_is_left_ends_at_powers_of_two_where_that_pads_less():
    fills = lambda counts: sorted(sum(k * n for k, n in p.items()) for p, _ in K.pack_lengths(counts, 2048))
    assert fills({1000: 1, 24: 1, 512: 1}) == [512, 1024]  # no padding, against 512 in one
    assert fills({1000: 1, 24: 3, 512: 1}) == [1584]  # 464, against 2000 for the last 48
    assert fills({2048: 2, 2000: 1, 48: 1, 5: 1}) == [5, 2048, 2048]
    assert K.pack_lengths({}, 2048) == []


def check(rows, docs, capacity=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in docs:
        ids = TOKENIZER.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    packed = K.pack_documents(docs, PATH).cache()
    n = check(packed.collect(), [tuple(r) for r in docs.collect()])
    padding = K.padding(packed).groupBy().sum("padding").first()[0]
    assert n > 400 and padding <= 0.02 * packed.groupBy().sum("length").first()[0]


def test_edges(spark):
    rnd = random.Random(1)
    docs = [(1, None), (2, ""), (3, "x " * 5000), (4, "<|endoftext|>")] + [(10 + i, "w " * rnd.randint(0, 900)) for i in range(60)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, length int, sequence_id int")
    check(K.pack_documents(df, PATH).collect(), docs)
    check(K.pack(K.pieces(df, PATH), block=7).collect(), docs)
    assert K.pack_documents(df.limit(0), PATH).count() == 0
    assert K.pack_documents(spark.createDataFrame([(None, "a"), (5, "b"), (5, "b")], "doc_id long, text string"), PATH).count() == 3
    seqs = K.padding(K.pack_documents(df, PATH)).collect()
    assert all(0 <= r.padding < 2048 for r in seqs)
