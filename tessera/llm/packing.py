"""Packing by minimum bin slack.

Documents are tokenised where they are read and cut: every full window of
``capacity`` ids is a sequence of its own; the rest of a document is one piece
of up to half a window, or half a window and a piece, as short pieces leave
little slack. Only piece rows (lengths and checksums) are
shuffled, never ids. A task packs its pieces in blocks of at most ``BLOCK``:
a subset-sum dynamic program over the bitset of reachable fill levels (one
Python integer, bit f set when some multiset of the remaining lengths fills
f) picks the multiset closest to the capacity, backtracking gives how often
each length is used, and the pattern is applied as often as the counts allow
before the program runs again. What no longer fills a window, at the end of a
block, is one open sequence, or several that end at powers of two, which need
no padding, where that leaves less.

Sequence ids are ``block * 2**32 + number`` with pieces sorted by document
inside a task, so a retried task makes the same sequences.

Defined results: a null or empty text is the end id alone. Repeated rows are
separate documents, ties sort by all fields; a null id is passed through. A
document longer than a window has several pieces. An empty table gives an
empty result; columns but ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, per_process

CAPACITY = 2048
END_ID = 1
#: Rows of remaining pieces that are packed together at most.
BLOCK = 100_000
#: Fixed value: the byte-level pre-tokenizer's pattern.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The shortest sequence that is made to end at a power of two.
LEAST_POWER = 64


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: a
    visible Latin-1 letter for itself, those from U+0100 on for the others."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def byte_ranks(spec: dict, tokenizer) -> dict[bytes, int] | None:
    """The vocabulary of a tokenizers file as byte ranks, if encoding by rank
    gives the file's ids: byte-level BPE without options, merges in the order
    of their tokens' ids, and every token merging to itself. Then the last two
    parts that make up a token's bytes are always those of its merge, so
    merging the pair of least rank is merging the first pair of the list."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
             and not spec.get("normalizer") and not spec.get("post_processor")
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    vocabulary, letters = model["vocab"], _byte_letters()
    if not plain or sorted(vocabulary.values()) != list(range(len(vocabulary))):
        return None
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if merged != list(range(len(vocabulary) - len(merged), len(vocabulary))) or any(c not in letters for t in vocabulary for c in t):
        return None
    if any(len(tokenizer.model.tokenize(t)) != 1 for t in vocabulary):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}


class Words:
    """The ids of a tokenizers file, without special tokens added. Where its
    vocabulary allows (``byte_ranks``) tiktoken computes them, the same ids in
    half the time; texts that hold an added token's string, and all texts of
    other vocabularies, go through tokenizers."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            ranks = byte_ranks(json.load(f), self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = ranks and tiktoken.Encoding("ranked", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if not self.ranked or any(t in text for t in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)


def encode(texts: list[str], words: Words) -> list[bytes]:
    """Ids of each text as 32-bit little-endian bytes."""
    from array import array

    return [array("I", words.ids(t)).tobytes() for t in texts]


def cut_pieces(ids: bytes, capacity: int):
    """(start, length, crc32) of each piece: full windows, then half a window
    if the rest holds one, then the rest."""
    n = len(ids) // 4
    cuts = list(range(0, n, capacity))
    if n - cuts[-1] > capacity // 2 and n - cuts[-1] < capacity:
        cuts.append(cuts[-1] + capacity // 2)
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(cuts, [*cuts[1:], n])]


def _tokenise(path: str, capacity: int):
    def run(batches):
        import pyarrow as pa

        words = per_process(f"hf:{path}", lambda: Words(path))
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            rows, docs = [], b.column("doc_id").to_pylist()
            for doc, text in zip(docs, b.column("text")):
                ids = encode([text.as_py() or ""], words)[0] + end
                rows += [(doc, s, n, c, len(ids) // 4) for s, n, c in cut_pieces(ids, capacity)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5,
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece."""
    bounded_batches(docs.sparkSession)
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(
        _tokenise(path, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def best_fill(counts: dict[int, int], capacity: int, powers: bool = False) -> dict[int, int]:
    """The multiset of the counted lengths whose sum is closest to, and not
    over, the capacity, as length -> times. Lengths go in descending order;
    ``levels[k]`` is the bitset of sums reachable with the first k of the
    binary-split items. With ``powers`` (for lengths that don't fill a window
    any more) the largest power of two from ``LEAST_POWER`` on is aimed at
    instead, if one can be reached, as it needs no padding."""
    items, levels, mask = [], [1], (1 << capacity + 1) - 1
    for length in sorted(counts, reverse=True):
        left, times = min(counts[length], capacity // length), 1
        while left:
            times = min(times, left)
            items.append((length, times))
            levels.append((levels[-1] | levels[-1] << length * times) & mask)
            left -= times
            times *= 2
        if levels[-1] >> capacity & 1:
            break
    at, used = levels[-1].bit_length() - 1, {}
    if powers:
        at = max((1 << k for k in range(capacity.bit_length()) if 1 << k >= LEAST_POWER and levels[-1] >> (1 << k) & 1), default=at)
    for (length, times), before in zip(reversed(items), reversed(levels[:-1])):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + times
            at -= length * times
    return used


def _padding(fill: int, capacity: int) -> int:
    return 0 if fill & (fill - 1) == 0 else capacity - fill


def _open_end(counts: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """Patterns for lengths that all fit into one window: one open sequence,
    or several that end at powers of two if these leave less padding."""
    rest, split = dict(counts), []
    while rest:
        split.append(best_fill(rest, capacity, powers=True))
        rest = {k: v - split[-1].get(k, 0) for k, v in rest.items() if v > split[-1].get(k, 0)}
    cost = lambda patterns: sum(_padding(sum(k * v for k, v in p.items()), capacity) for p in patterns)
    return split if cost(split) < cost([counts]) else [dict(counts)]


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, repeats) that use every counted length exactly once."""
    counts = {k: v for k, v in counts.items() if v}
    out = []
    while sum(k * v for k, v in counts.items()) >= capacity:
        pattern = best_fill(counts, capacity)
        times = min(counts[k] // v for k, v in pattern.items())
        counts = {k: v - pattern.get(k, 0) * times for k, v in counts.items() if v > pattern.get(k, 0) * times}
        out.append((pattern, times))
    return out + [(p, 1) for p in _open_end(counts, capacity)] if counts else out


def place(rows: list[tuple], capacity: int, first: int) -> list[tuple]:
    """(row, sequence_id, offset) of piece rows (..., length at 2)."""
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(r[2], []).append(r)
    for v in by_length.values():
        v.reverse()
    out, seq = [], first
    for pattern, times in pack_lengths({k: len(v) for k, v in by_length.items()}, capacity):
        for _ in range(times):
            offset = 0
            for length in sorted(pattern, reverse=True):
                for _ in range(pattern[length]):
                    out.append((*by_length[length].pop(), seq, offset))
                    offset += length
            seq += 1
    return out


def _pack(capacity: int, block: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        seq, held = TaskContext.get().partitionId() << 32, []

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for b in batches:
            full = []
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if r[2] == capacity:
                    full.append((*r, seq, 0))
                    seq += 1
                else:
                    held.append(r)
            if full:
                yield batch(full)
            if len(held) >= block:
                rows = place(held, capacity, seq)
                seq, held = rows[-1][-2] + 1, []
                yield batch(rows)
        if held:
            yield batch(place(held, capacity, seq))
    return run


def pack(piece_rows: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """The pieces with their sequence_id and offset."""
    bounded_batches(piece_rows.sparkSession, 4096)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    # one piece is one row, so a spread by document and start has no hot key
    run = piece_rows.select(*cols).repartition("doc_id", "start").sortWithinPartitions(*cols)
    return run.mapInArrow(_pack(capacity, block), ", ".join(f"{c} long" for c in [*cols, "sequence_id", "offset"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path, capacity), capacity)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, ids used and ids of padding (none at a power of two)."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.expr("used & (used - 1)") == 0
    return used.withColumn("padding", F.when(power, F.lit(0)).otherwise(capacity - F.col("used")))
