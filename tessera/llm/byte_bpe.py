"""Byte-level BPE through a sentencepiece model made from the vocabulary.

No tokenizer is trained: the ``.tiktoken`` rank file is serialised as a
sentencepiece BPE ``ModelProto``. Every token's bytes are mapped one to one
to letters, its score is the negative rank, and normalisation is the
identity, so the highest-scored merge is the one of least rank. Each match of
the pre-token pattern is encoded by itself; a match that is a token as it
stands is that token. Decoding maps ids back to bytes.

A worker keeps the decimal ids of words with a space before them (at most
``KEPT``), so a text's digest is a join of kept bytes; memory is bounded by
that and by one Arrow batch.

Defined results: a null text is empty, has no tokens and the digests of
nothing. Repeated rows each give a row, a null id is passed through, an empty
table gives an empty result; columns but ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame

from tessera.llm.common import bounded_batches, per_process

KEPT = 1_200_000
#: Texts whose words are looked up together.
GROUP = 64
#: The letters that stand for the 256 byte values: one block of letters that
#: has no white space, no marks and no compositions.
FIRST_LETTER = 0x4E00


LETTERS = {b: chr(FIRST_LETTER + b) for b in range(256)}


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value) -> bytes:
    """A protobuf field: bytes and text length-delimited, float fixed, else varint."""
    import struct

    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """Piece i is the token of rank i; the unknown piece comes last. The fields
    are those of the public sentencepiece_model.proto."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks are not 0..n-1")
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, letters(t)) + _field(2, float(-r)) + _field(3, normal)) for r, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normaliser = _field(1, "identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts to ids and ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.ranks, self.tokens = ranks, sorted(ranks, key=ranks.get)
        self.numbers = [str(i).encode() for i in range(len(ranks))]
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(model_proto(ranks))
        self.find = regex.compile(pattern).findall
        # of words with a space before them: the decimals of their ids, joined;
        # when they are KEPT / 2 they become the older half, and the older half goes
        self.decimals: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}  # words that don't decode to themselves (none of a whole vocabulary)

    def pretokens(self, found: list[str]) -> list[list[int]]:
        """Ids of pre-tokens, those that are no tokens in one call of the model."""
        ranks = [self.ranks.get(s.encode()) for s in found]
        rest = [letters(s.encode()) for s, r in zip(found, ranks) if r is None]
        made = iter(self.model.EncodeAsIds(rest, num_threads=1) if rest else [])  # a task has one core
        return [next(made) if r is None else [r] for r in ranks]

    def piece(self, s: str) -> list[int]:
        """Ids of a stretch of text whose ends are pre-token ends."""
        return [i for ids in self.pretokens(self.find(s)) for i in ids]

    def fill(self, words: set[str]) -> None:
        """Keep all these words."""
        new = words.difference(self.decimals)
        if not new:
            return
        if len(self.decimals) + len(new) > KEPT // 2:
            self.older, self.decimals = self.decimals, {}
            new = words
        for w in [w for w in new if w in self.older]:
            self.decimals[w] = self.older[w]
        new = [w for w in new if w not in self.older]
        # letters after a space are one pre-token
        found = [[" " + w] if w.isalpha() else self.find(" " + w) for w in new]
        made = iter(self.pretokens([s for f in found for s in f]))
        for w, f in zip(new, found):
            ids = [i for _ in f for i in next(made)]
            if (data := self.decode(ids)) != b" " + w.encode():
                self.others[w] = data
            self.decimals[w] = b",".join(map(self.numbers.__getitem__, ids))

    def encode(self, text: str) -> list[int]:
        first, words = cut(text)
        self.fill(set(words))
        return self.piece(first) + [int(i) for d in map(self.decimals.__getitem__, words) for i in d.split(b",")]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text the number of ids, hash of their decimals, hash of the
        bytes that they decode to. Every word's ids are decoded when they are
        made; a word that decodes to itself need not be decoded again."""
        pieces = [cut(t) for t in texts]
        self.fill(set().union(*(words for _, words in pieces)))
        out = []
        for text, (first, words) in zip(texts, pieces):
            ids = self.piece(first)
            parts = [b",".join(map(self.numbers.__getitem__, ids))] if ids else []
            decimals = b",".join([*parts, *map(self.decimals.__getitem__, words)])
            if self.others:
                data = b"".join([self.decode(ids), *(self.others.get(w) or b" " + w.encode() for w in words)])
            else:
                data = self.decode(ids) + text[len(first):].encode()
            out.append((decimals.count(b",") + bool(decimals), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(data).hexdigest()))
        return out


def cut(text: str) -> tuple[str, list[str]]:
    """What stands before the first cut, and the words after it without the
    space that each begins with. Texts are cut before spaces where a pre-token
    surely begins: the pattern never joins a character that is not white space
    to a space after it, and takes the last space before a word with that
    word. A space that follows white space, or ends the text after white
    space, may belong to a longer run, so such texts are not cut."""
    import re

    words = text.split(" ")
    if len(words) < 3 or re.search(r"\s (?:\s|\Z)", text):
        return text, []
    return words[0], words[1:]


def _run(path: str, pattern: str):
    def run(batches):
        import pyarrow as pa

        codec = per_process(f"bpe:{path}", lambda: Codec(load_ranks(path), pattern))
        for b in batches:
            made = []
            for i in range(0, b.num_rows, GROUP):
                made += codec.digests([t or "" for t in b.column("text").slice(i, GROUP).to_pylist()])
            n, ids_hash, text_hash = zip(*made) if made else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                                              pa.array(text_hash, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(path: str, pattern: str):
    def run(batches):
        import pyarrow as pa

        codec = per_process(f"bpe:{path}", lambda: Codec(load_ranks(path), pattern))
        for b in batches:
            ids = [codec.encode(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return run


def _bytes(path: str, pattern: str):
    def run(batches):
        import pyarrow as pa

        codec = per_process(f"bpe:{path}", lambda: Codec(load_ranks(path), pattern))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([codec.decode(x or []) for x in b.column("ids").to_pylist()], pa.binary())],
                                             names=["doc_id", "data"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of the text."""
    bounded_batches(docs.sparkSession)
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(_ids(path, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for."""
    bounded_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_bytes(path, pattern), "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes."""
    bounded_batches(docs.sparkSession)
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(
        _run(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
