"""BPE ids against the tiktoken library; exact byte round trips."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import byte_bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = B.load_ranks(PATH)


@pytest.fixture(scope="module")
def codec():
    return B.Codec(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n\t\x1c\xa0s\u3000é中1.,", max_size=40)))
def test_ids_and_round_trip(codec, library, text):
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_long_runs(codec, library):
    for text in ("a" * 5000, " " * 3000 + "x", "\x00" * 700, "ab " * 4000, "<|endoftext|> x"):
        assert codec.encode(text) == library.encode_ordinary(text)


def test_whole_table_and_edges(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-3, "dup"), (-3, "dup")], "doc_id long, text string")
    rows = docs.union(more).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    out = B.round_trip(docs.union(more), PATH, P.PATTERN)
    assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == sorted(want)
    assert B.round_trip(more.limit(0), PATH, P.PATTERN).count() == 0
    back = B.decode(B.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.data).decode() for r in back.collect()} == {r.doc_id: r.text for r in docs.collect()}
